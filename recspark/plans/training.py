"""The training-sample run: samples to encoded splits, a vocabulary from the train split, and reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.operators import clean, encode, quality, sequences, split, vocab, windows
from recspark.operators.point_in_time import sequences_before
from recspark.operators.registry import CATEGORICAL, CONTINUOUS, DEFAULT_COUNTED, DEFAULT_ELEMENTS, DEFAULT_READS, ELEMENTS, Registry, default_builders, with_windows
from recspark.plans.stages import Stages, source_digest
from recspark.sources import sinks
from recspark.sources.scratch import written
from recspark.sources.tfrecord import write_tfrecord

#: The features that samples are encoded with by default, name: (index, kind).
DEFAULT_FEATURES = {
    "user_id": (1, CATEGORICAL),
    "user_age": (2, CATEGORICAL),
    "user_gender": (3, CATEGORICAL),
    "user_occupation": (4, CATEGORICAL),
    "movie_id": (101, CATEGORICAL),
    "movie_title": (102, CATEGORICAL),
    "movie_genres": (103, CATEGORICAL),
    "movie_rate_count": (104, CATEGORICAL),
    "movie_rate_avg": (105, CATEGORICAL),
    "movie_genre_cnt": (106, CATEGORICAL),
    "item_hot_rank": (107, CATEGORICAL),
    "movie_publish_year": (108, CATEGORICAL),
    "movie_rate_avg_continue": (109, CONTINUOUS),
    "context_time_hour": (201, CATEGORICAL),
    "context_time_area": (202, CATEGORICAL),
    "context_time_week": (203, CATEGORICAL),
    "context_is_weekend": (204, CATEGORICAL),
    "user_top3_genres": (103, CATEGORICAL),
    "user_same_genre_avg_rate": (356, CATEGORICAL),
    "user_same_genre_avg_rate_continue": (357, CONTINUOUS),
}
#: Families of features by window. first index, step of the index, names by window.
DEFAULT_FAMILIES = [
    (6, 1, CATEGORICAL, ["user_rate_std", "user_rate_std_7day", "user_rate_std_15day", "user_rate_std_30day"]),
    (10, 1, CONTINUOUS, ["user_rate_std_continue", "user_rate_std_7day_continue", "user_rate_std_15day_continue", "user_rate_std_30day_continue"]),
    (14, 1, CATEGORICAL, ["user_rate_avg", "user_rate_avg_7day", "user_rate_avg_15day", "user_rate_avg_30day"]),
    (18, 1, CONTINUOUS, ["user_rate_avg_continue", "user_rate_avg_7day_continue", "user_rate_avg_15day_continue", "user_rate_avg_30day_continue"]),
    (22, 1, CATEGORICAL, ["user_movie_rate_cnt", "user_movie_rate_7day_cnt", "user_movie_rate_15day_cnt", "user_movie_rate_30day_cnt"]),
    (26, 1, CONTINUOUS, ["user_movie_rate_cnt_continue", "user_movie_rate_7day_cnt_continue", "user_movie_rate_15day_cnt_continue", "user_movie_rate_30day_cnt_continue"]),
    (101, 0, CATEGORICAL, ["user_movie_rate_ids", *[f"user_movie_rate_id_{d}days" for d in (1, 3, 7, 15)]]),
    (103, 0, CATEGORICAL, ["user_movie_rate_genres", *[f"user_movie_rate_genre_{d}days" for d in (1, 3, 7, 15)]]),
    (103, 0, CATEGORICAL, ["user_genres_rate", *[f"user_genres_rate_{d}day" for d in (1, 3, 7, 15)]]),
    (103, 0, CATEGORICAL, ["user_genres_rate_cnts", *[f"user_genres_rate_cnt_{d}days" for d in (1, 3, 7, 15)]]),
    (351, 1, CATEGORICAL, ["user_watch_same_genre", *[f"user_watch_same_genre_{d}day" for d in (1, 3, 7, 15)]]),
]


#: The crosses, name: (index, parents). None is enabled by default.
CROSSES: dict[str, tuple[int, list[str]]] = {
    "movie_genres_xx_user_genres_rate": (401, ["movie_genres", "user_genres_rate"]),
    "movie_genres_xx_user_genres_rate_1day": (402, ["movie_genres", "user_genres_rate_1day"]),
    "movie_publish_year_xx_user_age": (406, ["movie_publish_year", "user_age"]),
    "movie_rate_count_xx_user_rate_std": (410, ["movie_rate_count", "user_rate_std"]),
    "movie_hot_rank_xx_user_rate_avg": (411, ["item_hot_rank", "user_rate_avg"]),
    "movie_publish_year_xx_user_rate_avg": (412, ["movie_publish_year", "user_rate_avg"]),
    "movie_genre_cnt_xx_user_rate_avg": (413, ["movie_genre_cnt", "user_rate_avg"]),
    "movie_hot_rank_xx_user_genre_avg_rate": (414, ["item_hot_rank", "user_same_genre_avg_rate"]),
    "movie_genres_xx_user_gender": (417, ["movie_genres", "user_gender"]),
    "movie_genres_xx_user_occupation": (418, ["movie_genres", "user_occupation"]),
    "movie_genres_xx_user_age": (419, ["movie_genres", "user_age"]),
    "movie_genres_xx_is_weekend": (450, ["movie_genres", "context_is_weekend"]),
    "movie_hot_rank_xx_is_weekend": (451, ["item_hot_rank", "context_is_weekend"]),
    "user_age_xx_is_weekend": (452, ["user_age", "context_is_weekend"]),
    "user_gender_xx_context_time_hour": (453, ["user_gender", "context_time_hour"]),
    "movie_genres_xx_user_age_xx_user_gender": (460, ["movie_genres", "user_age", "user_gender"]),
    "movie_genres_xx_user_gender_xx_user_occupation": (461, ["movie_genres", "user_gender", "user_occupation"]),
    "movie_publish_year_xx_user_age_xx_user_occupation": (462, ["movie_publish_year", "user_age", "user_occupation"]),
    "movie_rate_avg_xx_movie_hot_rank_xx_user_rate_avg": (463, ["movie_rate_avg", "item_hot_rank", "user_rate_avg"]),
    "movie_genre_cnt_xx_user_total_rate_cnt_xx_user_rate_avg": (465, ["movie_genre_cnt", "user_movie_rate_cnt", "user_rate_avg"]),
    "movie_genre_cnt_xx_movie_hot_rank_xx_user_genre_avg_rate": (466, ["movie_genre_cnt", "item_hot_rank", "user_same_genre_avg_rate"]),
    "movie_publish_year_xx_movie_rate_avg_xx_user_rate_avg": (467, ["movie_publish_year", "movie_rate_avg", "user_rate_avg"]),
}


def default_registry(only: list[str] | None = None, crosses: list[str] | None = None) -> Registry:
    """The default features, or those named, and the default crosses, of which those named in ``crosses`` are enabled."""
    out, builders = Registry(prepare=with_windows), default_builders()
    all_ = dict(DEFAULT_FEATURES)
    for first, step, kind, names in DEFAULT_FAMILIES:
        all_ |= {n: (first + step * k, kind) for k, n in enumerate(names)}
    for name, (index, kind) in all_.items():
        if only is None or name in only:
            out.register(name, index, kind, builders[name], element=DEFAULT_ELEMENTS.get(name), counted=DEFAULT_COUNTED.get(name), reads=DEFAULT_READS.get(name))
    for name, (index, depends) in CROSSES.items():
        out.cross(name, index, depends, name in (crosses or []))
    return out


def samples(ix: DataFrame, items: DataFrame, users: DataFrame, n: int = 200, as_of: bool = False) -> DataFrame:
    """Interactions with label, profile, item features and history, ready for the registry.

    A history is what lies before the sample of the user's ``n`` last items (of the whole table, each by its last event), or ``as_of`` the
    ``n`` events before the sample: then an early sample of a long history has one too, and no user's rows meet in one task.
    """
    joined = plain_samples(ix, items, users)
    if as_of:
        return sequences_before(joined, n, F.struct("item_id", "rating", F.col("time_stamp").alias("ts"), F.col("item_feature.genres").alias("genres")))
    return windows.with_history(joined, histories(ix, items, n))


def plain_samples(ix: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """``samples`` without history."""
    return clean.labelled(sequences.join_samples(ix, users, None, sequences.item_stats(ix, items)))


def histories(ix: DataFrame, items: DataFrame, n: int = 200) -> DataFrame:
    """user_id and ``seq``: each user's ``n`` last items with their genres."""
    return sequences.with_genres(sequences.user_sequences(ix, n), items)


def reading_histories(registry: Registry, seqs: DataFrame, n: int | None = None) -> Registry:
    """``registry`` for ``plain_samples``: the history comes to a row where its features are made.

    So rows are written, split and shuffled without histories, which are many times their size. Rows and ``seqs`` meet by a shuffle of both, which deals
    also a small table to all tasks.

    ``n`` tells that no sequence of ``seqs`` is longer, and that each goes from the newest element to the oldest, as ``histories`` does: then features of single elements are
    looked up and counted once an element, not once a row and element.
    """

    def prepare(df: DataFrame) -> DataFrame:
        df = windows.with_history(df, seqs.hint("merge"))
        return registry.prepare(df) if registry.prepare else df

    return Registry(registry.features, prepare, seqs if n is not None and n <= ELEMENTS else None)


@dataclass
class Run:
    encoded: DataFrame
    pos_map: DataFrame
    target_map: DataFrame | None
    report: DataFrame


#: Splits of a run, as folders of its output.
SPLITS = ("train", "val", "test")


def run(
    rows: DataFrame,
    registry: Registry,
    mode: str = "multi",
    keep_negatives: float = 1.0,
    train: float = 0.8,
    val: float = 0.1,
    feature_threshold: int = 10,
    target_threshold: int = 1,
    key: str = "sample_id",
    previous_vocab: DataFrame | None = None,
    previous_targets: DataFrame | None = None,
    split_by: str = "time",
    stages: Stages | None = None,
    version: str = "",
) -> Run:
    """Down-sample, split, build the vocabulary on the train split, encode all splits.

    ``rows`` come from ``samples`` with a unique ``key``. They are split by ``time`` in the given ratios, or a user's last row is test and the
    one before it val (``last``). A row without a surviving feature or a mapped target is dropped. The vocabulary and targets of an
    earlier run, where given, keep their positions and are added to.

    With ``stages``, samples, targets, positions, encoded rows and report are tables of that job, and finished ones aren't made again.
    ``version`` names what the files of ``rows`` don't tell (see ``source_digest``): the query over them and the features' builders.
    """
    if split_by not in ("time", "last"):
        raise ValueError(f"split_by {split_by} is neither time nor last")
    if stages is None:
        keep = lambda name, inputs, make, by=None: written(make(), name)
        last = lambda name, inputs, make, by=None: make()
        source = old = ""
    else:
        keep = last = stages.table
        source = source_digest(rows, version)
        old = [None if p is None else source_digest(p, version) for p in (previous_vocab, previous_targets)]

    sampled = [source, mode, keep_negatives, key]
    rows = keep("samples", sampled, lambda: split.downsample_negatives(rows, keep_negatives, F.col(key)).withColumn("target", clean.target(mode)))

    @cache
    def parted() -> DataFrame:
        if split_by == "last":
            return split.leave_one_out_split(rows, "user_id", [F.col("time_stamp").desc(), F.col(key).desc()])
        return split.time_ratio_split(rows, [F.col("time_stamp"), F.col(key)], train, val)

    def learned() -> DataFrame:
        return parted().where("split = 'train'")

    cut = [*sampled, split_by, *([train, val] if split_by == "time" else [])]
    features = [[f.name, f.index, f.kind, list(f.depends)] for f in registry.active()]
    of_targets, of_positions = [cut, target_threshold, old], [cut, features, feature_threshold, old]
    target_map = None
    if mode == "multi":
        target_map = keep("targets", of_targets, lambda: vocab.build_target_map(learned().where("target is not null").select("target"), target_threshold, previous_targets))
    pos_map = keep("positions", of_positions, lambda: vocab.build_pos_map(vocab.feature_stats(registry, learned(), key), feature_threshold, previous_vocab))

    def encoded() -> DataFrame:
        found = encode.encode_rows(parted(), pos_map, registry, key, keep=["split", "label", "rating", "target"]).where("has_feature")
        return encode.with_targets(found, target_map)

    def report() -> DataFrame:
        out = None
        for name in SPLITS:
            one = quality.stage_report(parted().where(F.col("split") == name).withColumn("parse_ok", F.col("target").isNotNull()), name)
            out = one if out is None else out.unionByName(one)
        return out

    done = last("encoded", [of_positions, of_targets if mode == "multi" else None], encoded, by=["split"])
    return Run(done, pos_map, target_map, last("report", cut, report))


def write_run(done: Run, registry: Registry, path: str, fmt: str = "parquet") -> None:
    """The encoded rows of a run in a folder a split, as Parquet or TFRecord files, and its vocabulary, which ``previous_run`` reads."""
    fields = pos_fields(registry, done.pos_map.sparkSession)
    for name in SPLITS:
        one = done.encoded.where(F.col("split") == name).drop("split")
        if fmt == "tfrecords":
            write_tfrecord(one, f"{path}/{name}", "overwrite")
        else:
            one.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
    targets = done.target_map if done.target_map is not None else done.pos_map.sparkSession.createDataFrame([], "target int, idx long, cnt long")
    sinks.write_vocabulary(done.pos_map, targets, vocab.pos_dim(done.pos_map, fields), f"{path}/vocabulary")


def pos_fields(registry: Registry, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f.name, f.index, f.kind) for f in registry.active()], "field_name string, field_index int, field_type int")


def previous_run(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The vocabulary and targets that ``write_run`` left, as arguments of the next run."""
    positions, targets, _ = sinks.read_vocabulary(spark, f"{path}/vocabulary")
    return {"previous_vocab": positions, "previous_targets": targets}
