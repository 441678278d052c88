"""Jobs over a registry folder: register, process, clean up, export. Each is one plan and one write per table."""

from __future__ import annotations

import argparse
import logging
import time
import uuid
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators import registry, splits
from framewright.plans import stages
from framewright.sources import readers, versions, writers

log = logging.getLogger(__name__)
REGISTRY = (
    "source string, url string, video_processor array<struct<name:string,config:string>>, channel_ids array<string>, art_style array<string>, art_genre array<string>, "
    "art_media array<string>, is_playlist boolean, only_channel_vid boolean, video_id string, title string, license string, channel string, channel_id string, "
    "processed boolean, exclude_video boolean"
)
COLUMNS = [c.strip().split()[0] for c in REGISTRY.split(", ")]


def register_files(spark: SparkSession, base: str, files: list[str], catalog: DataFrame) -> DataFrame:
    """Add the items of JSON-lines files to the registry under ``base``.

    Of equal ids the first stays, by the order of the files given and of their lines. Files that do not
    exist are reported and left out, and so are those with another suffix. Jobs that register at the same time all keep their rows.
    """
    usable = []
    for f in files:
        if not readers.exists(spark, f):
            log.error("%s does not exist", f)
        elif PurePosixPath(f).suffix != ".jsonl":
            log.warning("%s is not a .jsonl file", f)
        else:
            usable.append(f)
    if not usable:
        return versions.read(spark, f"{base}/registry", REGISTRY)
    items = readers.read_items(spark, usable[0])
    for n, f in enumerate(usable[1:], 1):
        items = items.unionByName(readers.read_items(spark, f, n))

    def with_new(known: DataFrame) -> DataFrame:
        return known.unionByName(registry.register(items, catalog, known, order=["catalog_file", "line", "id"]).select(*COLUMNS))

    versions.update(spark, f"{base}/registry", REGISTRY, with_new)
    return versions.read(spark, f"{base}/registry", REGISTRY)


def mark_processed(spark: SparkSession, base: str, done: DataFrame) -> None:
    """Items that a run has finished; a rerun leaves them alone."""
    flags = done.select("source", "video_id").distinct().withColumn("__done", F.lit(True))

    def marked(known: DataFrame) -> DataFrame:
        rest = known.join(flags, ["source", "video_id"], "left")
        return rest.withColumn("processed", F.coalesce("processed", F.lit(False)) | F.coalesce("__done", F.lit(False))).select(*COLUMNS)

    versions.update(spark, f"{base}/registry", REGISTRY, marked)


COMMIT = "source string, video_id string, run string, marks boolean, n_rows long, " + ", ".join(f"{c} {t}" for c, t in stages.STATE.items())
#: Places of a recording that one file holds, and hours after which a run that was never committed goes.
FILE_FRAMES, ORPHAN_HOURS = 1 << 16, 24


def read_commits(spark: SparkSession, base: str) -> DataFrame:
    """The last commit of each item: its run, how many rows it stored, and what is known of the item since; ``ever`` if one of its commits marks it."""
    rows = readers.read_registry(spark, f"{base}/commits", COMMIT)
    columns = [c.split()[0] for c in COMMIT.split(", ")][2:]
    return rows.groupBy("source", "video_id").agg(F.max(F.struct(*columns)).alias("c"), F.bool_or("marks").alias("ever")).select("source", "video_id", "c.*", "ever")


def _runs(spark: SparkSession, base: str) -> dict[str, tuple[int, int]]:
    """Of each committed run, how many items it stored and how many of these are stored nowhere since."""
    stored = readers.read_registry(spark, f"{base}/commits", COMMIT).groupBy("run").agg(F.count_if(F.col("n_rows") > 0).alias("n"))
    live = read_commits(spark, base).where("n_rows > 0").groupBy("run").agg(F.count("*").alias("live"))
    return {r["run"]: (r["n"], r["live"] or 0) for r in stored.join(live, "run", "left").collect()}


def read_processed(spark: SparkSession, base: str) -> DataFrame:
    """The processed frames of each item as of its last commit.

    Runs whose items are all current are read as they are; only of those that were replaced in part, rows meet the items' commits.
    """
    runs = _runs(spark, base)
    if not any(live for _, live in runs.values()):
        return spark.createDataFrame([], f"source string, video_id string, k string, i long, v long, run string, {', '.join(f'{c} {t}' for c, t in stages.STATE.items())}")
    rows = spark.read.parquet(f"{base}/processed")
    whole, part = ([r for r, (n, live) in runs.items() if live and (live == n) == all_] for all_ in (True, False))
    current = read_commits(spark, base).where("n_rows > 0").select("source", "video_id", "run")
    found = rows.where(F.col("run").isin(whole))
    return found.unionByName(rows.where(F.col("run").isin(part)).join(current, ["source", "video_id", "run"], "left_semi").select(*rows.columns)) if part else found


def vacuum(spark: SparkSession, base: str, hours: float = ORPHAN_HOURS) -> list[str]:
    """Delete the runs of which nothing is current: replaced ones, and those that began ``hours`` ago and were never committed."""
    runs, gone = _runs(spark, base), []
    for name in writers.folders(spark, f"{base}/processed"):
        run = name.removeprefix("run=")
        begun = int(run.split("-")[0]) / 1e9
        if (run in runs and runs[run][1] == 0) or (run not in runs and begun < time.time() - 3600 * hours):
            writers.delete(spark, f"{base}/processed/{name}")
            gone.append(run)
    return gone


def settle(spark: SparkSession, base: str) -> None:
    """Mark what an earlier run committed and did not come to mark."""
    open_ = registry.unprocessed(versions.read(spark, f"{base}/registry", REGISTRY)).select("source", "video_id")
    left = read_commits(spark, base).where("ever").join(open_, ["source", "video_id"], "left_semi")
    if left.limit(1).count():
        mark_processed(spark, base, left)


def store(spark: SparkSession, base: str, items: DataFrame, done: DataFrame, marks: bool) -> DataFrame:
    """Store ``done`` (source, video_id, ..., state) as a run of its own, then commit ``items``; the commit rows.

    An item's last commit names the run that holds it, so a rerun replaces what was stored, a crash before the commit
    leaves the old rows in force, and a crash behind it loses no more than the marks, which the next run sets. Replaced runs go at once,
    others with ``vacuum``. A run's files hold many items each: a folder an item took 26 s to commit 1,500 items.
    """
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    done.repartition("source", "video_id", F.floor(F.col("i") / FILE_FRAMES)).write.parquet(f"{base}/processed/run={run}")
    return commit(spark, base, run, items, marks)


def commit(spark: SparkSession, base: str, run: str, items: DataFrame, marks: bool) -> DataFrame:
    """Commit rows of ``items`` for a run whose data is stored; an item without rows is committed with none."""
    state = [F.max(c).alias(c) for c in stages.STATE]
    fresh = spark.read.parquet(f"{base}/processed/run={run}").groupBy("source", "video_id").agg(F.count("*").alias("n_rows"), *state)
    rows = items.select("source", "video_id").distinct().join(fresh, ["source", "video_id"], "left")
    rows = rows.withColumns({"run": F.lit(run), "marks": F.lit(marks), "n_rows": F.coalesce("n_rows", F.lit(0).cast("long"))})
    rows.select(*[c.split()[0] for c in COMMIT.split(", ")]).write.mode("append").parquet(f"{base}/commits")
    vacuum(spark, base)
    return readers.read_registry(spark, f"{base}/commits", COMMIT).where(F.col("run") == run)


def process_registry(spark: SparkSession, base: str, only: tuple[str, str] | None = None, override: tuple[str, str] | None = None) -> DataFrame:
    """Run the unprocessed items of a registry through their own stages, replace their results in ``processed``, and mark the items.

    ``only`` names one (source, video_id), which may be processed already; ``override`` is a stage's
    (name, config) in place of every item's list, for all items that are not excluded, and leaves their flags. Series are keyed by ``k``,
    source:video_id. What an earlier run found out of an item, its range or canvas, stays known.
    """
    settle(spark, base)
    items = versions.read(spark, f"{base}/registry", REGISTRY)
    if only is not None:
        items = registry.lookup(items, *only)
    if override is not None:
        items = registry.override_stage(items.where(~F.coalesce(F.col("exclude_video"), F.lit(False))), *override)
    if only is None and override is None:
        items = registry.unprocessed(items)
    if items.limit(1).count() == 0:
        return read_processed(spark, base)
    # Stages run on stored recordings, so frames and references of an earlier run do not count as had.
    known = read_commits(spark, base).select("source", "video_id", *[c for c in stages.STATE if not c.startswith("has_")])
    todo = items.select("source", "video_id", "video_processor").join(known, ["source", "video_id"], "left")
    done = stages.run_lists(todo, spark.read.parquet(f"{base}/frames"), ["source", "video_id"], key=F.concat_ws(":", "source", "video_id"))
    pixel = [c for c in ("y", "x") if c in done.columns]
    kept = done.select("source", "video_id", "k", "i", *pixel, "v", *stages.STATE)
    committed = store(spark, base, todo, kept, marks=override is None)
    if override is None:
        mark_processed(spark, base, committed)
    return read_processed(spark, base)


def clean_up(spark: SparkSession, base: str, variations: bool = False, tags: bool = False) -> None:
    """Take the variations of reference frames, their tags, or both out of the stored tables."""
    if variations:
        writers.save_registry(registry.drop_variations(spark.read.parquet(f"{base}/reference_frames")), f"{base}/reference_frames")
    if tags:
        writers.save_registry(registry.clear_tags(spark.read.parquet(f"{base}/video_meta")), f"{base}/video_meta")


def export_pipelines(spark: SparkSession, bases: list[str], out: str, **options) -> None:
    """Several pipelines in one dataset, by split."""
    for n, base in enumerate(bases):
        export_split(spark, base, out, mode="append" if n else "errorifexists", **options)


def export_split(spark: SparkSession, base: str, out: str, split_file: str | None = None, train: float = 0.8, evaluate: float = 0.1, seed: int = 42, only_listed: bool = False, mode: str = "errorifexists") -> None:
    """Eligible items with their frames, by split."""
    frames = spark.read.parquet(f"{base}/frames")
    kept = registry.eligible(versions.read(spark, f"{base}/registry", REGISTRY), frames, ["source", "video_id"]).select("source", "video_id")
    listed = readers.read_split_file(spark, split_file) if split_file else None
    assigned = splits.assign_split(kept, listed, ["source", "video_id"], "video_id", train, evaluate, seed, only_listed)
    splits.export_split(frames.join(assigned, ["source", "video_id"]), out, mode)


def export_folds(spark: SparkSession, base: str, out: str, n: int = 5, seed: int = 42) -> None:
    """Eligible items with their frames, once a fold."""
    frames = spark.read.parquet(f"{base}/frames")
    kept = registry.eligible(versions.read(spark, f"{base}/registry", REGISTRY), frames, ["source", "video_id"]).select("source", "video_id")
    dealt = splits.fold_sets(splits.folds(kept, "source", "video_id", n, seed), n).drop("chunk")
    splits.export_folds(frames.join(dealt, ["source", "video_id"]), out)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Registry jobs")
    parser.add_argument("job", choices=["register", "process", "vacuum", "clean-up", "export-split", "export-folds"])
    parser.add_argument("--base", required=True)
    parser.add_argument("--files", nargs="*", default=[])
    parser.add_argument("--catalog", help="Parquet table of url, id, title, license, channel, channel_id")
    parser.add_argument("--only", nargs=2, metavar=("SOURCE", "ID"), help="process this item alone")
    parser.add_argument("--override", nargs=2, metavar=("STAGE", "CONFIG"), help="one stage for every item")
    parser.add_argument("--variations", action="store_true", help="clean up the variations of reference frames")
    parser.add_argument("--tags", action="store_true", help="clean up the tags of reference frames")
    parser.add_argument("--more", nargs="*", default=[], help="further pipelines for the same dataset")
    parser.add_argument("--out")
    parser.add_argument("--split-file")
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--seed", type=int, default=42)
    o = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if o.job == "register":
        register_files(spark, o.base, o.files, spark.read.parquet(o.catalog))
    elif o.job == "process":
        process_registry(spark, o.base, tuple(o.only) if o.only else None, tuple(o.override) if o.override else None)
    elif o.job == "vacuum":
        log.info("deleted runs: %s", ", ".join(vacuum(spark, o.base)) or "none")
    elif o.job == "clean-up":
        clean_up(spark, o.base, o.variations, o.tags)
    elif o.job == "export-split":
        export_pipelines(spark, [o.base, *o.more], o.out, split_file=o.split_file, seed=o.seed)
    else:
        export_folds(spark, o.base, o.out, o.folds, o.seed)


if __name__ == "__main__":
    main()
