"""The feature registry: configuration that compiles to one array column a feature, and the melted tokens.

A feature is a column array<struct<raw string, key string, fea long, value double, parts array>>. ``key`` identifies the
value in a vocabulary, and ``fea`` is its number, or null for string values, whose number is the hash of the key; number
0 is padding and is left out. ``parts`` of a cross holds the index, key and number of each parent's value, else null.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions import scalars as X

CATEGORICAL, CONTINUOUS = 1, 0
PARTS = "array<struct<field_index:int,key:string,fea:bigint>>"
TOKEN = f"array<struct<raw:string,key:string,fea:bigint,value:double,parts:{PARTS}>>"


@dataclass
class Feature:
    name: str
    index: int
    kind: int
    build: Callable[[], Column] | None = None
    enabled: bool = True
    depends: tuple[str, ...] = ()
    #: For a feature whose values are those of the history's elements, in their order: the token of one element, null if it has none.
    element: Callable[[Column], Column] | None = None
    #: For a default feature of a history: what ``history_stats`` counts in place of its tokens, and the days of its window.
    counted: tuple[str, int | None] | None = None
    #: The columns, or fields ``column.field``, that alone decide the tokens, if known.
    reads: tuple[str, ...] | None = None


@dataclass
class Registry:
    features: list[Feature] = field(default_factory=list)
    #: Adds columns that several builders read, so that they are made once a row.
    prepare: Callable[[DataFrame], DataFrame] | None = None
    #: user_id and ``seq``, of which rows have what lies before their time_stamp as history; known where histories come to rows late and ELEMENTS bounds them.
    histories: DataFrame | None = None

    def register(self, name: str, index: int, kind: int, build: Callable[[], Column], enabled: bool = True, element: Callable[[Column], Column] | None = None, counted: tuple[str, int | None] | None = None, reads: tuple[str, ...] | None = None) -> None:
        """The extension point: any builder of a token column. With ``element``, ``build`` must give the tokens of the history's elements that aren't null;
        with ``counted``, it must be the default builder of that; with ``reads``, it must read nothing else."""
        self.features.append(Feature(name, index, kind, build, enabled, (), element, counted, reads))

    def cross(self, name: str, index: int, depends: Iterable[str], enabled: bool = False) -> None:
        self.features.append(Feature(name, index, CATEGORICAL, None, enabled, tuple(depends)))

    def active(self) -> list[Feature]:
        """Enabled features; a cross whose parents aren't all enabled categorical features is skipped."""
        plain = {f.name: f for f in self.features if f.enabled and not f.depends}
        return [*plain.values(), *[f for f in self.features if f.enabled and f.depends and all(d in plain and plain[d].kind == CATEGORICAL for d in f.depends)]]

    def by_element(self) -> list[Feature]:
        """Active features that can be made once an element of ``histories``, not once a row."""
        return [f for f in self.active() if f.element is not None] if self.histories is not None else []

    def by_history(self) -> list[Feature]:
        """Other active features that can be counted over ``histories`` without making tokens. That reads all histories once more, so it is for
        registries in which some of them have a list of values a row."""
        found = [f for f in self.active() if f.counted is not None and f.element is None] if self.histories is not None else []
        return found if any(f.counted[0] in LISTS for f in found) else []

    def output_columns(self) -> list[str]:
        return [f"{f.name}_{part}" for f in self.active() for part in ("raw", "index", "value")]

    def columns(self, df: DataFrame) -> DataFrame:
        """``df`` with a token column for every active feature."""
        if self.prepare:
            df = self.prepare(df)
        plain = {f.name: f.build().cast(TOKEN) for f in self.active() if not f.depends}
        df = df.withColumns(plain)
        return df.withColumns({f.name: crossed([(p.index, F.col(p.name)) for d in f.depends for p in self.features if p.name == d]).cast(TOKEN) for f in self.active() if f.depends})

    def tokens(self, df: DataFrame, key: str = "sample_id", only: Iterable[str] | None = None) -> DataFrame:
        """(key, field_name, field_index, field_type, ord, raw, key, fea, value, parts): one row per feature value, melted in one pass.

        ``only`` names the active features whose values are wanted, if not all are.
        """
        made, only = self.columns(df), None if only is None else set(only)
        fields = [
            F.struct(F.lit(f.name).alias("field_name"), F.lit(f.index).alias("field_index"), F.lit(f.kind).alias("field_type"), F.col(f.name).alias("list")) for f in self.active() if only is None or f.name in only
        ]
        one = made.select(F.col(key), F.explode(F.array(*fields)).alias("f")).select(key, "f.field_name", "f.field_index", "f.field_type", F.posexplode("f.list").alias("ord", "t"))
        return one.select(key, "field_name", "field_index", "field_type", "ord", "t.raw", "t.key", "t.fea", "t.value", "t.parts")


def load(config: dict, builders: dict[str, Callable[[], Column]], prepare: Callable[[DataFrame], DataFrame] | None = None) -> Registry:
    """A registry from parsed configuration: features (field_name, field_index, field_type, enabled) and cross_features (… depends).

    A feature without a builder is left out with a warning. ``default_builders`` need ``prepare`` to be ``with_windows``.
    """
    out = Registry(prepare=prepare)
    for f in config.get("features") or []:
        if f["field_name"] in builders:
            out.register(f["field_name"], f["field_index"], f["field_type"], builders[f["field_name"]], f.get("enabled", True))
        elif f.get("enabled", True):
            warnings.warn(f"no builder for feature {f['field_name']}", stacklevel=2)
    for f in config.get("cross_features") or []:
        out.cross(f["field_name"], f["field_index"], f["depends"], f.get("enabled", True))
    return out


def load_yaml(text: str, builders: dict[str, Callable[[], Column]], prepare: Callable[[DataFrame], DataFrame] | None = None) -> Registry:
    """``load`` of YAML text; needs the yaml package."""
    import yaml

    return load(yaml.safe_load(text) or {}, builders, prepare)


def as_config(registry: Registry) -> dict:
    """The configuration that ``load`` makes the same registry of, given the same builders."""
    shared = [{"field_name": f.name, "field_index": f.index, "enabled": f.enabled} for f in registry.features]
    plain = [{**c, "field_type": f.kind} for c, f in zip(shared, registry.features, strict=True) if not f.depends]
    return {"features": plain, "cross_features": [{**c, "depends": list(f.depends)} for c, f in zip(shared, registry.features, strict=True) if f.depends]}


def as_yaml(registry: Registry) -> str:
    """``as_config`` as YAML text; needs the yaml package."""
    import yaml

    return yaml.safe_dump(as_config(registry), sort_keys=False)


def _token(raw: Column, key: Column, fea: Column, value: Column, parts: Column | None = None) -> Column:
    parts = F.lit(None) if parts is None else parts
    return F.struct(raw.cast("string").alias("raw"), key.cast("string").alias("key"), fea.cast("long").alias("fea"), value.cast("double").alias("value"), parts.cast(PARTS).alias("parts"))


def number(c: Column, value: Column | float = 1.0) -> Column:
    """One categorical value; 0 and null are padding."""
    kept = F.filter(F.array(F.coalesce(c.try_cast("long"), F.lit(0))), lambda n: n != 0)
    return F.transform(kept, lambda n: _token(n, n, n, value if isinstance(value, Column) else F.lit(value)))


def continuous(c: Column) -> Column:
    return F.array(_token(F.lit("1"), F.lit("1"), F.lit(1), c))


def string_list(c: Column, value: float = 1.0) -> Column:
    return F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.isNotNull()), lambda x: _token(x, x, F.lit(None), F.lit(value)))


#: Elements of a history that ``id_list`` and ``first_genres`` read at most.
ELEMENTS = 200


def item_token(h: Column) -> Column:
    """The item of an element with its rating as value; null for number 0."""
    number = F.coalesce(h["item_id"].try_cast("long"), F.lit(0))
    return F.when(number != 0, _token(h["item_id"], number, number, h["rating"]))


def genre_token(h: Column) -> Column:
    """The first genre of an element with its rating; null without genre."""
    first = F.get(h["genres"], F.lit(0))
    return F.when(F.coalesce(F.size(h["genres"]), F.lit(0)) > 0, _token(first, first, F.lit(None), h["rating"]))


def id_list(history: Column, limit: int = ELEMENTS) -> Column:
    """Items of a history with their ratings as values."""
    return F.filter(F.transform(F.slice(history, 1, limit), item_token), lambda t: t.isNotNull())


def first_genres(history: Column, limit: int = ELEMENTS) -> Column:
    """The first genre of each element with its rating; elements without genre are left out."""
    return F.filter(F.transform(F.slice(history, 1, limit), genre_token), lambda t: t.isNotNull())


#: What a single element of the whole history gives to these features of ``default_builders``.
DEFAULT_ELEMENTS: dict[str, Callable[[Column], Column]] = {"user_movie_rate_ids": item_token, "user_movie_rate_genres": genre_token}


def genre_values(stats: Column, what: str) -> Column:
    return F.transform(stats, lambda s: _token(s["genre"], s["genre"], F.lit(None), s[what]))


def crossed(parents: list[tuple[int, Column]]) -> Column:
    """All combinations of the parents' values, value 1; raw and key are ``index:raw`` joined by ``__xx__``."""
    out = None
    for index, tokens in parents:
        named = _named(tokens, index)
        out = named if out is None else F.flatten(F.transform(out, _pair(named)))
    return out


def _named(tokens: Column, index: int) -> Column:
    return F.transform(tokens, lambda t: _token(F.concat(F.lit(f"{index}:"), t["raw"]), F.concat(F.lit(f"{index}:"), t["key"]), F.lit(None), F.lit(1.0), F.array(F.struct(F.lit(index), t["key"], t["fea"]))))


def _pair(right: Column):
    return lambda a: F.transform(right, lambda b: _token(F.concat_ws("__xx__", a["raw"], b["raw"]), F.concat_ws("__xx__", a["key"], b["key"]), F.lit(None), F.lit(1.0), F.concat(a["parts"], b["parts"])))


#: Names and indexes of features whose history windows share an index.
WINDOW_DAYS = {"": None, "_7day": 7, "_15day": 15, "_30day": 30}


#: Of ``default_builders``: what ``history_stats`` counts, by name.
DEFAULT_COUNTED: dict[str, tuple[str, int | None]] = {"user_top3_genres": ("top3", None), "user_same_genre_avg_rate": ("same", None), "user_same_genre_avg_rate_continue": ("same_value", None)}
for _tag, _d in WINDOW_DAYS.items():
    for _what, _name in (("std", f"user_rate_std{_tag}"), ("avg", f"user_rate_avg{_tag}"), ("cnt", f"user_movie_rate{_tag}_cnt")):
        DEFAULT_COUNTED |= {_name: (_what, _d), f"{_name}_continue": (f"{_what}_value", _d)}
for _d in (None, 1, 3, 7, 15):
    _one, _many = ("", "") if _d is None else (f"_{_d}day", f"_{_d}days")
    DEFAULT_COUNTED |= {f"user_movie_rate_id{_many or 's'}": ("id", _d), f"user_movie_rate_genre{_many or 's'}": ("first_genre", _d)}
    DEFAULT_COUNTED |= {f"user_genres_rate{_one}": ("genre_avg", _d), f"user_genres_rate_cnt{_many or 's'}": ("genre_cnt", _d), f"user_watch_same_genre{_one}": ("watched", _d)}
#: Of ``default_builders``: what the features of the row's user, item and time read.
DEFAULT_READS: dict[str, tuple[str, ...]] = {
    "user_id": ("user_id",), "user_age": ("user_profile.age",), "user_gender": ("user_profile.gender",), "user_occupation": ("user_profile.occupation",), "user_zip_code": ("user_profile.zip_code",),
    "movie_id": ("item_id",), "movie_title": ("item_feature.title",), "movie_genres": ("item_feature.genres",), "movie_rate_count": ("item_feature.rate_count",),
    "movie_rate_avg": ("item_feature.avg_rate",), "movie_rate_avg_continue": ("item_feature.avg_rate",), "movie_genre_cnt": ("item_feature.genres",),
    "item_hot_rank": ("item_feature.hot_rank",), "movie_publish_year": ("item_feature.title",),
    "context_time_hour": ("time_stamp",), "context_time_area": ("time_stamp",), "context_time_week": ("time_stamp",), "context_is_weekend": ("time_stamp",),
}
#: What of ``DEFAULT_COUNTED`` has a list of values a row.
LISTS = {"id", "first_genre", "genre_avg", "genre_cnt"}


def with_windows(df: DataFrame) -> DataFrame:
    """``df`` with its history's windows, their means and deviations, and their genre statistics, which ``default_builders`` read.

    Each is made once a row, a window from the next larger one, and elements are dealt to genres once for all windows; columns that no feature
    reads are pruned.
    """
    now, wider = F.col("time_stamp"), "history"
    for d in (None, 30, 15, 7, 3, 1):
        df, wider = df.withColumn(f"__history_{d}", X.within(F.col(wider), now, d)), f"__history_{d}"
    df = df.withColumns({f"__avg_{d}": X.mean_rating(F.col(f"__history_{d}")) for d in WINDOW_DAYS.values()})
    df = df.withColumns({f"__std_{d}": X.std_rating(F.col(f"__history_{d}"), F.col(f"__avg_{d}")) for d in WINDOW_DAYS.values()})
    df = df.withColumn("__elements", X.genre_elements(F.col("__history_None")))
    return df.withColumns({f"__genres_{d}": X.stats_within(F.col("__elements"), now, d) for d in (None, 1, 3, 7, 15)})


def default_builders() -> dict[str, Callable[[], Column]]:
    """Builders over samples with user_id, item_id, time_stamp, user_profile, item_feature (structs) and history, after ``with_windows``."""
    c, p, i = F.col, lambda n: F.col(f"user_profile.{n}"), lambda n: F.col(f"item_feature.{n}")
    h = lambda d: F.col(f"__history_{d}")
    g = lambda d: F.col(f"__genres_{d}")
    b: dict[str, Callable[[], Column]] = {
        "user_id": lambda: number(c("user_id")),
        "user_age": lambda: number(p("age")),
        "user_gender": lambda: number(X.gender_code(p("gender"))),
        "user_occupation": lambda: number(p("occupation")),
        "user_zip_code": lambda: string_list(F.array(p("zip_code"))),
        "movie_id": lambda: number(c("item_id")),
        "movie_title": lambda: string_list(X.title_tokens(i("title"))),
        "movie_genres": lambda: string_list(F.transform(i("genres"), F.lower)),
        "movie_rate_count": lambda: number(X.item_count_bucket(i("rate_count"))),
        "movie_rate_avg": lambda: number(X.item_avg_bucket(i("avg_rate"))),
        "movie_rate_avg_continue": lambda: continuous(i("avg_rate")),
        "movie_genre_cnt": lambda: number(F.least(F.size(i("genres")), F.lit(3))),
        "item_hot_rank": lambda: number(X.hot_rank_bucket(i("hot_rank"))),
        "movie_publish_year": lambda: number(X.year_bucket(X.release_year(i("title")))),
        "context_time_hour": lambda: number(X.hour_of(c("time_stamp")) + 1),
        "context_time_area": lambda: number(F.floor(X.hour_of(c("time_stamp")) / 4) + 1),
        "context_time_week": lambda: number(X.weekday_of(c("time_stamp"))),
        "context_is_weekend": lambda: number(F.when(X.weekday_of(c("time_stamp")) >= 6, 2).otherwise(1)),
        "user_top3_genres": lambda: genre_values(X.top_genres(g(None)), "cnt"),
        "user_same_genre_avg_rate": lambda: number(X.once(X.same_genre_mean(g(None), i("genres")), X.genre_avg_bucket)),
        "user_same_genre_avg_rate_continue": lambda: continuous(X.same_genre_mean(g(None), i("genres"))),
    }

    def add(name: str, build: Callable[[int | None], Column], d: int | None) -> None:
        b[name] = lambda: build(d)

    for tag, d in WINDOW_DAYS.items():
        add(f"user_rate_std{tag}", lambda d: number(X.rate_std_bucket(c(f"__std_{d}"))), d)
        add(f"user_rate_std{tag}_continue", lambda d: continuous(c(f"__std_{d}")), d)
        add(f"user_rate_avg{tag}", lambda d: number(X.rate_avg_bucket(c(f"__avg_{d}"))), d)
        add(f"user_rate_avg{tag}_continue", lambda d: continuous(c(f"__avg_{d}")), d)
        cnt = f"user_movie_rate{tag}_cnt"
        add(cnt, lambda d: number(X.rate_count_bucket(F.size(h(d)))), d)
        add(f"{cnt}_continue", lambda d: continuous(F.size(h(d))), d)
    for d in (None, 1, 3, 7, 15):
        one, many = ("", "") if d is None else (f"_{d}day", f"_{d}days")
        add("user_movie_rate_ids" if d is None else f"user_movie_rate_id{many}", lambda d: id_list(h(d)), d)
        add("user_movie_rate_genres" if d is None else f"user_movie_rate_genre{many}", lambda d: first_genres(h(d)), d)
        add(f"user_genres_rate{one}", lambda d: genre_values(g(d), "avg"), d)
        add("user_genres_rate_cnts" if d is None else f"user_genres_rate_cnt{many}", lambda d: genre_values(g(d), "cnt"), d)
        overlap = lambda d: F.arrays_overlap(F.coalesce(i("genres"), F.array().cast("array<string>")), F.flatten(F.transform(F.filter(h(d), lambda x: x["genres"].isNotNull()), lambda x: x["genres"])))
        add(f"user_watch_same_genre{one}", lambda d, o=overlap: number(F.when(F.coalesce(o(d), F.lit(False)), 2).otherwise(1)), d)
    return b
