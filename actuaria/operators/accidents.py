"""Road-accident enrichment: one row per accident (header) with road type and surface
(lieux), worst injury code and number of road users (usagers) and number of vehicles
(vehicules).

Spark form: all years are read at once (the year comes from the folder), and the
pipeline is keyed by (annee, Num_Acc) instead of a loop per year and a union. The four
files go through as one tagged union, each read once: equal rows of an accident are combined to
one row with their number (on the map side first, so an accident with very many road or user rows is a few
rows a task), then one grouped pass merges an accident's headers, roads, worst injury and
counts. Two exchanges serve all four files; what an accident repeats is written out by several tasks.

As in the source data model: ``nb_victimes`` counts every road user (not only the
injured) and ``gravite_max`` is the maximum of the severity *codes*.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: output names of the accident columns ---------------------------
RENAME = {
    "Num_Acc": "accident_id",
    "mois": "mois",
    "jour": "jour",
    "hrmn": "heure",
    "dep": "departement",
    "com": "commune",
    "atm": "conditions_meteo",
    "lum": "luminosite",
    "catr": "type_voie",
    "surf": "etat_surface",
    "grav": "gravite_max",
}
# ------------------------------------------------------------------------------------


def _usable(df: DataFrame | None) -> bool:
    return df is not None and "Num_Acc" in df.columns


def enrich_accidents(
    header: DataFrame,
    lieux: DataFrame | None = None,
    usagers: DataFrame | None = None,
    vehicules: DataFrame | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Join the four accident files. A missing file (None, or without ``Num_Acc``)
    contributes no columns; columns absent from the header are simply not renamed.

    ``keys`` defaults to (annee, Num_Acc) when every file carries ``annee``, else
    Num_Acc alone.
    """
    if "annee" not in header.columns:
        header = header.withColumnRenamed("an", "annee")
    elif "an" in header.columns:
        header = header.drop("an")
    parts = [d for d in (lieux, usagers, vehicules) if _usable(d)]
    if keys is None:
        keys = ["annee", "Num_Acc"] if all("annee" in d.columns for d in parts) else ["Num_Acc"]
    if not parts:
        return header.withColumnsRenamed(RENAME)

    rest = [c for c in header.columns if c not in keys]
    rows = [header.select(*keys, F.lit("header").alias("_kind"), F.struct(*rest, F.lit(0).alias("_")).alias("_header"))]

    def tagged(df: DataFrame, kind: str, *values: Column) -> DataFrame:
        # an accident of any other type of key, or without one, never matches a header
        of_header = [F.col(k).cast(header.schema[k].dataType).alias(k) for k in keys]
        whole = reduce(lambda p, q: p & q, [F.col(k).isNotNull() for k in keys])
        return df.select(*of_header, F.lit(kind).alias("_kind"), *values).where(whole)

    if _usable(lieux):
        rows.append(tagged(lieux, "road", F.struct("catr", "surf").alias("_road")))
    # users and vehicles are counted alike: of both together an accident has one row
    if _usable(usagers):
        rows.append(tagged(usagers, "count", F.col("grav"), F.lit(1).alias("nb_victimes")))
    if _usable(vehicules):
        rows.append(tagged(vehicules, "count", F.lit(1).alias("nb_vehicules")))
    every = reduce(lambda p, q: p.unionByName(q, allowMissingColumns=True), rows)

    # equal rows of an accident are one row with their number from here on
    payload = [c for c in ("_header", "_road") if c in every.columns]
    worst = [F.max("grav").alias("grav")] if _usable(usagers) else []
    counts = [F.sum(c).alias(c) for c in ("nb_victimes", "nb_vehicules") if c in every.columns]  # null where there is none
    # the number of the accident leads the grouping: sorts then compare it, not years that are all alike
    grouping = sorted(keys, key=lambda k: k != "Num_Acc")
    combined = every.groupBy(*grouping, "_kind", *payload).agg(F.count("*").alias("_n"), *worst, *counts)
    roads = F.collect_list(F.when(F.col("_kind") == "road", F.struct("_road", "_n"))) if _usable(lieux) else F.array()
    merged = combined.groupBy(*grouping).agg(
        F.collect_list(F.when(F.col("_kind") == "header", F.struct("_header", "_n"))).alias("_headers"),
        roads.alias("_roads"),
        *worst,
        *counts,
    )
    others = [c for c in ("grav", "nb_victimes", "nb_vehicules") if c in merged.columns]
    opened = merged.select(*keys, F.explode("_headers").alias("_h"), "_roads", *others)
    if _usable(lieux):
        opened = opened.select(*keys, "_h", F.explode_outer("_roads").alias("_r"), *others)
        times, of_road = F.col("_h._n") * F.coalesce("_r._n", F.lit(1)), ["_r._road.catr", "_r._road.surf"]
    else:
        times, of_road = F.col("_h._n"), []
    out = opened.select(*keys, *(f"_h._header.{c}" for c in rest), *of_road, *others, times.alias("_times"))
    return _repeated(out, "_times").withColumnsRenamed(RENAME)


REPEATS_A_TASK, SPLIT = 100_000, 32


def _repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column ``times`` says; a row repeated very often is written by
    several tasks."""
    few = df.where(F.col(times) <= REPEATS_A_TASK).withColumn("_i", F.explode(F.sequence(F.lit(1), times)))
    parts = F.sequence(F.lit(0), F.expr(f"({times} - 1) div {REPEATS_A_TASK}"))
    dealt = df.where(F.col(times) > REPEATS_A_TASK).withColumn("_part", F.explode(parts)).repartition(SPLIT, "_part")
    left = F.least(F.lit(REPEATS_A_TASK), F.col(times) - F.col("_part") * REPEATS_A_TASK)
    many = dealt.withColumn("_i", F.explode(F.sequence(F.lit(1), left))).drop("_part")
    return few.unionByName(many).drop("_i", times)


# ---- CSV files -------------------------------------------------------------------------

KINDS = ("caract", "lieux", "vehic", "usag")
COLUMN_TYPES = {
    "Num_Acc": "bigint",
    "an": "int",
    "mois": "int",
    "jour": "int",
    "hrmn": "string",
    "dep": "string",
    "com": "string",
    "atm": "int",
    "lum": "int",
    "catr": "int",
    "surf": "int",
    "grav": "int",
}


def _existing(spark, folders: list[str]) -> list[str]:
    """The folders that exist, found without listing anything else."""
    found = []
    for folder in folders:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
            found.append(folder)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    return found


def accident_files_by_kind(spark, root: str, years: list[int] | None = None) -> dict[str, dict[str, list[str]]]:
    """``{kind: {folder: [csv files or folders of part files]}}`` under ``root``.

    A file belongs to a kind when its name (or the name of the ``*.csv`` folder of
    part files that holds it) contains the kind, ignoring case; its folder is the
    directory above that name (the year). With ``years`` only those year folders are
    listed. Part files are reduced to their folder on the executors, so the driver gets
    a row per year and kind, not per file.
    """
    roots = [root] if years is None else _existing(spark, [f"{root.rstrip('/')}/{y}" for y in years])
    groups: dict[str, dict[str, list[str]]] = {k: {} for k in KINDS}
    if not roots:
        return groups
    path = F.col("path")
    parent = F.regexp_replace(path, "/[^/]+$", "")
    named = F.when(F.lower(parent).endswith(".csv"), parent).otherwise(path)
    name = F.lower(F.substring_index(named, "/", -1))
    kind = F.coalesce(*[F.when(name.contains(k), k) for k in KINDS])
    folder = F.substring_index(F.regexp_replace(named, "/[^/]+$", ""), "/", -1)
    units = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(roots)
        .select(kind.alias("kind"), folder.alias("folder"), named.alias("unit"))
        .where("kind is not null")
        .distinct()
    )
    for row in units.orderBy("unit").collect():
        groups[row["kind"]].setdefault(row["folder"], []).append(row["unit"])
    return groups


def read_accident_kind(spark, paths_by_folder: dict[str, list[str]]) -> DataFrame | None:
    """One kind of file over all folders (``;``-separated, ISO-8859-1).

    The column layout changed over the years: folders with the same header are read as
    one scan, and the layouts are aligned by column name, missing columns as NULL (the plan
    grows with the layouts, not with the folders). Everything is read as text (no inference
    pass); known columns are cast with ``try_cast``. No file: None.
    """
    reader = spark.read.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
    layouts: dict[tuple, list[str]] = {}
    for _, paths in sorted(paths_by_folder.items()):
        layouts.setdefault(tuple(reader.csv(paths).columns), []).extend(paths)
    source = F.col("_metadata.file_path")
    parent = F.regexp_replace(source, "/[^/]+$", "")
    named = F.when(F.lower(parent).endswith(".csv"), parent).otherwise(source)
    folder = F.substring_index(F.regexp_replace(named, "/[^/]+$", ""), "/", -1)
    frames = []
    for columns, paths in layouts.items():
        known = [
            F.expr(f"try_cast(`{c}` as {COLUMN_TYPES[c]})").alias(c) if c in COLUMN_TYPES else F.col(f"`{c}`")
            for c in columns
        ]
        frames.append(reader.csv(paths).select(*known, folder.alias("_folder")))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_accident_dir(spark, root: str, years: list[int] | None = None) -> DataFrame | None:
    """Enriched accidents for the year folders under ``root`` (None if no header).

    Files are matched to their header within the same folder; ``annee`` is the folder
    name when it is a year, else the header's ``an``. ``years`` reads those folders only;
    a year without a folder contributes no rows.
    """
    files = accident_files_by_kind(spark, root, years)
    frames = {k: read_accident_kind(spark, files[k]) for k in KINDS}
    header = frames["caract"]
    if header is None:
        return None
    folder = F.col("_folder")
    year = F.when(folder.rlike(r"^\d{4}$"), folder.cast("int"))
    if "an" in header.columns:
        year = F.coalesce(year, F.col("an"))
    header = header.withColumn("annee", year).drop("an")
    out = enrich_accidents(
        header, frames["lieux"], frames["usag"], frames["vehic"], keys=["_folder", "Num_Acc"]
    )
    return out.drop("_folder")


# ---- partitioned source ------------------------------------------------------------------


def write_accident_source(files: dict[str, DataFrame], root: str) -> None:
    """The four files as ``;``/ISO-8859-1 CSV under ``root/<kind>/annee=<year>/``.

    Only headers know their year; the other files get it by a join on ``Num_Acc`` (rows without a
    header go to the default partition). One job per kind whatever the number of years, all at
    the same time, so that the last tasks of one kind leave no executor idle;
    ``rebalance`` spreads a very large year over several writer tasks.
    """
    years = files["caract"].select("Num_Acc", F.col("an").alias("annee")).distinct()

    def write(kind: str) -> None:
        df = files[kind]
        of_year = df.withColumnRenamed("an", "annee") if kind == "caract" else df.join(years, "Num_Acc", "left")
        (
            of_year.hint("rebalance", "annee").write.mode("overwrite").partitionBy("annee")
            .option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
            .csv(f"{root.rstrip('/')}/{kind}")
        )

    with ThreadPoolExecutor(max_workers=len(files)) as pool:
        list(pool.map(inheritable_thread_target(years.sparkSession)(write), files))


def read_accident_source(
    spark, root: str, years: list[int] | None = None, kinds: tuple[str, ...] = KINDS
) -> dict[str, DataFrame]:
    """The files under ``root/<kind>/annee=<year>/`` with ``annee`` as a partition column.

    ``years`` prunes the folders of every kind before a file is opened; later filters on
    ``annee`` do the same. Known columns are cast with ``try_cast``; no inference pass.
    """
    reader = spark.read.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1")
    frames = {}
    for kind in kinds:
        df = reader.csv(f"{root.rstrip('/')}/{kind}")
        known = [
            F.expr(f"try_cast(`{c}` as {COLUMN_TYPES[c]})").alias(c) if c in COLUMN_TYPES else F.col(f"`{c}`")
            for c in df.columns
            if c != "annee"
        ]
        df = df.select(F.col("annee").cast("int").alias("annee"), *known)
        frames[kind] = df if years is None else df.where(F.col("annee").isin(list(years)))
    return frames


def enrich_source(files: dict[str, DataFrame]) -> DataFrame:
    """Enriched accidents of the files of :func:`read_accident_source`."""
    return enrich_accidents(files["caract"], files["lieux"], files["usag"], files["vehic"], keys=["annee", "Num_Acc"])


def write_accidents(enriched: DataFrame, path: str) -> None:
    """Store enriched accidents as Parquet partitioned by year (full replace of the
    years present; a reader filtering on ``annee`` prunes the other folders).

    ``rebalance`` groups rows by year so each task writes few folders, and adaptive
    execution splits a very large year over several tasks instead of one.
    """
    (
        enriched.hint("rebalance", "annee")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("annee")
        .parquet(path)
    )
