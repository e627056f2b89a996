"""Counts and moments of the tokens of a history's default features, summed over Arrow batches of rows; no token is made.

A row comes with its user's sequence. In each slice of rows the elements before the row, and their genres, are laid out in numpy arrays, and each
feature gives a partial row a key: n tokens, of which ``valued`` have a value, and the values' sum, sum_sq, mean and m2. Values and buckets are
those of ``registry.default_builders``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions import scalars as X
from recspark.operators.registry import Feature, item_token

PARTIAL = "field_name string, field_index int, field_type int, key string, n long, valued long, sum double, sum_sq double, mean double, m2 double"
#: Elements of a slice's sequences, or those of a single row.
SLICE = 1 << 17

#: What is made of a window's ratings.
OF_WINDOWS = {"std", "std_value", "avg", "avg_value", "cnt", "cnt_value"}
#: What is counted by genre, and what of it reads the genres of the row's item.
OF_GENRES, OF_ITEM = {"genre_avg", "genre_cnt", "top3", "same", "same_value", "watched"}, {"same", "same_value", "watched"}
_STD, _GENRE, _COUNT = (0, 1, 2), (1, 2, 3, 4), (0, 10, 30, 50, 100)


def _bucket(value: np.ndarray, bounds: tuple, null: np.ndarray | None = None) -> np.ndarray:
    """``scalars.bucket``: null and NaN lie beyond all bounds."""
    at = np.searchsorted(np.asarray(bounds, np.float64), value, "left") + 1
    return at if null is None else np.where(null, len(bounds) + 1, at)


def _avg_bucket(value: np.ndarray, null: np.ndarray) -> np.ndarray:
    """``scalars.rate_avg_bucket``."""
    return np.where(null, 4, np.where(value == 0, 1, np.where(value < 3, 2, np.where(value < 4, 3, 4))))


class _Partials:
    """The partial rows of a slice."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []

    def add(self, f: Feature, code: np.ndarray, keys: list[str | None], value: np.ndarray | float, null: np.ndarray | None = None) -> None:
        """Tokens of a feature: the place of each one's key, and its value, null where told."""
        if not len(code):
            return
        n = np.bincount(code, minlength=len(keys))
        value = np.broadcast_to(np.asarray(value, np.float64), code.shape)
        known, v = (code, value) if null is None or not null.any() else (code[~null], value[~null])
        valued, total, squares = (np.bincount(known, w, minlength=len(keys)) for w in (None, v, v * v))
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = total / valued
            m2 = np.bincount(known, (v - mean[known]) ** 2, minlength=len(keys))
        has = np.flatnonzero(n)
        none = valued[has] == 0
        self.parts.append(pa.record_batch([
            pa.array([f.name] * len(has)),
            pa.array(np.full(len(has), f.index, np.int32)),
            pa.array(np.full(len(has), f.kind, np.int32)),
            pa.array([keys[i] for i in has.tolist()], pa.string()),
            pa.array(n[has].astype(np.int64)),
            pa.array(valued[has].astype(np.int64)),
            *[pa.array(x[has], pa.float64(), mask=none) for x in (total, squares, mean, m2)],
        ], names=[x.split(" ")[0] for x in PARTIAL.split(", ")]))


def _filled(a: pa.Array, zero: float) -> tuple[np.ndarray, np.ndarray]:
    """Values, and which of them are null."""
    null = a.is_null().to_numpy(zero_copy_only=False)
    return (a.fill_null(zero) if a.null_count else a).to_numpy(zero_copy_only=False), null


def _lists(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Lengths of lists, 0 for null, and their elements."""
    return a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), a.flatten()


def _coded(a: pa.Array) -> tuple[np.ndarray, list[str | None]]:
    """Places of strings among the distinct ones, the last of which is null, and these."""
    d = a.dictionary_encode()
    keys = d.dictionary.to_pylist()
    return d.indices.fill_null(len(keys)).to_numpy(zero_copy_only=False).astype(np.int64), [*keys, None]


def _slice_partials(rows: pa.RecordBatch, features: list[Feature]) -> list[pa.RecordBatch]:
    out, wanted = _Partials(), {f.counted[0] for f in features}
    n_rows = rows.num_rows
    now, no_time = _filled(rows.column("now"), 0)
    length, flat = _lists(rows.column("seq"))
    size, number, rating, ts, genres, first = flat.flatten()
    row = np.repeat(np.arange(n_rows), length)
    ts, never = _filled(ts, 0)
    kept = ~never & ~no_time[row] & (ts < now[row])
    at = np.flatnonzero(kept)
    row, age = row[at], (now[row] - ts)[at]
    rating, unrated = (x[at] for x in _filled(rating, 0.0))
    # an age below 0 has passed the range of longs
    inside = {d: np.ones(len(at), bool) if d is None else (age <= d * X.DAY) & (age >= 0) for d in {f.counted[1] for f in features}}

    def of(what: str) -> list[Feature]:
        return [f for f in features if f.counted[0] == what]

    if wanted & OF_WINDOWS:
        for d in {f.counted[1] for f in features if f.counted[0] in OF_WINDOWS}:
            own = [f for f in features if f.counted[1] == d]
            r, x, no = row[inside[d]], rating[inside[d]], unrated[inside[d]]
            cnt = np.bincount(r, minlength=n_rows)
            null = np.bincount(r[no], minlength=n_rows) > 0
            some = np.maximum(cnt, 1)
            mean = np.where(cnt > 0, np.bincount(r, x, minlength=n_rows) / some, 3.0)
            std = np.where(cnt > 0, np.sqrt(np.bincount(r, (x - mean[r]) ** 2, minlength=n_rows) / some), 0.0)
            scalars = {
                "std": _bucket(std, _STD, null), "avg": _avg_bucket(mean, null), "cnt": _bucket(cnt, _COUNT),
                "std_value": (std, null), "avg_value": (mean, null), "cnt_value": (cnt.astype(np.float64), None),
            }
            for f in own:
                found = scalars.get(f.counted[0])
                if isinstance(found, tuple):
                    out.add(f, np.zeros(n_rows, np.int64), ["1"], *found)
                elif found is not None:
                    out.add(f, found, [str(k) for k in range(8)], 1.0)
    if wanted & {"id"}:
        code, keys = _coded(number)
        known = code[at] < len(keys) - 1
        for f in of("id"):
            m = known & inside[f.counted[1]]
            out.add(f, code[at][m], keys, rating[m], unrated[m])
    if wanted & {"first_genre"}:
        code, keys = _coded(first)
        code, known = code[at], (size.to_numpy(zero_copy_only=False) > 0)[at]
        for f in of("first_genre"):
            m = known & inside[f.counted[1]]
            out.add(f, code[m], keys, rating[m], unrated[m])
    if wanted & OF_GENRES:
        n_genres, all_genres = _lists(genres)
        n_own, own_genres = _lists(rows.column("genres"))
        code, keys = _coded(pa.concat_arrays([all_genres.cast(pa.string()), own_genres.cast(pa.string())]))
        # codes in the order of the genres' bytes, so that groups of a row, and sums over them, go by genre
        ranked = sorted(range(len(keys) - 1), key=lambda i: keys[i].encode())
        rank = np.empty(len(keys), np.int64)
        rank[[*ranked, len(keys) - 1]] = np.arange(len(keys))
        keys, code, none = [*[keys[i] for i in ranked], None], rank[code], len(keys) - 1
        element = np.repeat(np.arange(len(n_genres)), n_genres)
        place = np.full(len(n_genres), -1)
        place[at] = np.arange(len(at))
        theirs, mine = code[: len(element)], code[len(element) :]
        real = (place[element] >= 0) & (theirs != none)
        element, theirs = place[element[real]], theirs[real]
        asked = (np.repeat(np.arange(n_rows), n_own) * len(keys) + mine)[mine != none]
        of_group = row[element] * len(keys) + theirs
        if n_rows * len(keys) <= 2 * len(of_group) + 1000:  # few genres: a group for each of a row, of which those without elements are passed over
            group = np.arange(n_rows * len(keys))
            hit = np.bincount(asked, minlength=len(group)) > 0
        else:
            group, of_group = np.unique(of_group, return_inverse=True)
            hit = np.isin(group, asked)
        of_row, of_genre = group // len(keys), group % len(keys)
        for d in {f.counted[1] for f in features if f.counted[0] in OF_GENRES}:
            own = [f for f in features if f.counted[1] == d]
            m = inside[d][element]
            g, x, no = of_group[m], rating[element[m]], unrated[element[m]]
            cnt = np.bincount(g, minlength=len(group))
            some = cnt > 0
            avg = np.bincount(g, x, minlength=len(group)) / np.maximum(cnt, 1)
            null = np.bincount(g[no], minlength=len(group)) > 0
            for f in own:
                what = f.counted[0]
                if what == "genre_avg":
                    out.add(f, of_genre[some], keys, avg[some], null[some])
                elif what == "genre_cnt":
                    out.add(f, of_genre[some], keys, cnt[some])
                elif what == "top3":
                    order = np.lexsort((of_genre, -cnt, of_row))
                    order = order[some[order]]
                    r = of_row[order]
                    best = order[np.arange(len(r)) - np.searchsorted(r, r, "left") < 3]
                    out.add(f, of_genre[best], keys, cnt[best])
                elif what == "watched":
                    seen = np.bincount(of_row[hit & some], minlength=n_rows) > 0
                    out.add(f, np.where(seen, 2, 1), ["0", "1", "2"], 1.0)
                elif what in ("same", "same_value"):
                    s = hit & some
                    k = np.bincount(of_row[s], minlength=n_rows)
                    mean = np.where(k > 0, np.bincount(of_row[s], avg[s], minlength=n_rows) / np.maximum(k, 1), 3.0)
                    unknown = np.bincount(of_row[s & null], minlength=n_rows) > 0
                    if what == "same":
                        out.add(f, _bucket(mean, _GENRE, unknown), [str(k) for k in range(8)], 1.0)
                    else:
                        out.add(f, np.zeros(n_rows, np.int64), ["1"], mean, unknown)
    return out.parts


def partial_stats(rows: DataFrame, histories: DataFrame, features: list[Feature], most: int = SLICE) -> DataFrame:
    """Partial rows (PARTIAL) of the features' tokens in ``rows``, whose histories are what lies before them of ``histories``; ``most`` elements are laid out at once."""
    lean = [Feature(f.name, f.index, f.kind, counted=f.counted) for f in features]
    read = {f.counted[0] for f in features}
    asked = F.col("item_feature.genres") if read & OF_ITEM else F.lit(None).cast("array<string>")

    def element(e: Column) -> Column:
        # what no feature reads is null, as it is sent with each row
        number = item_token(e)["key"] if "id" in read else F.lit(None)
        genres = F.array_distinct(F.array_compact(e["genres"])) if read & OF_GENRES else F.lit(None)
        first = F.get(e["genres"], F.lit(0)) if "first_genre" in read else F.lit(None)
        return F.struct(
            F.coalesce(F.size(e["genres"]), F.lit(0)).alias("size"), number.cast("string").alias("number"), e["rating"].cast("double").alias("rating"), e["ts"].cast("long").alias("ts"),
            genres.cast("array<string>").alias("genres"), first.cast("string").alias("first"),
        )

    seqs = histories.select("user_id", F.transform("seq", element).alias("seq"))
    with_seq = rows.select("user_id", F.col("time_stamp").cast("long").alias("now"), asked.alias("genres")).join(seqs.hint("merge"), "user_id", "left")
    with_seq = with_seq.select("now", "genres", X.within(F.col("seq"), F.col("now"), None).alias("seq"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(b.column("seq").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            a = 0
            while a < b.num_rows:
                before = ends[a - 1] if a else 0
                z = max(a + 1, int(np.searchsorted(ends, before + most, "right")))
                yield from _slice_partials(b.slice(a, z - a), lean)
                a = z

    return with_seq.mapInArrow(run, PARTIAL)
