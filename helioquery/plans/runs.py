"""Resumable runs: tile manifests, sidecars that vouch for artifacts, chained keys, guards, and the city run that uses them.

Texts are read and written by the file system of their path, whatever Spark knows, so manifest and results lie together.
"""

from __future__ import annotations

import hashlib
import json
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import areas
from .city import write_city

SURFACE_VERSION, RADIATION_VERSION, SCORING_VERSION = "1", "1", "2-4.5"


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(conf)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    jvm, where, fs = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step, so that no reader sees half of it."""
    jvm, where, fs = _fs(spark, path)
    fs.mkdirs(where.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(draft, where, options)


class Manifest:
    """What is known of each tile of a run: done under a key with so many roofs, or failed with an error."""

    def __init__(self, spark: SparkSession, path: str):
        """An unreadable manifest counts as empty, with a warning: every tile is scored anew."""
        self.spark, self.path, self.entries = spark, path, {}
        text = read_text(spark, path)
        if text is not None:
            try:
                self.entries = json.loads(text)
            except ValueError:
                warnings.warn(f"manifest {path} is no valid JSON; every tile is scored anew", stacklevel=2)

    def save(self) -> None:
        write_text(self.spark, self.path, json.dumps(self.entries, sort_keys=True, indent=1))

    def is_current(self, row: int, col: int, stamp: str) -> bool:
        entry = self.entries.get(f"{row}_{col}", {})
        return entry.get("status") == "done" and entry.get("stamp") == stamp

    def mark_done(self, row: int, col: int, stamp: str, n_roofs: int) -> None:
        self.entries[f"{row}_{col}"] = {"status": "done", "stamp": stamp, "n_roofs": n_roofs}

    def mark_failed(self, row: int, col: int, stamp: str, error: str) -> None:
        self.entries[f"{row}_{col}"] = {"status": "failed", "stamp": stamp, "error": error}

    def error_for(self, row: int, col: int) -> str | None:
        entry = self.entries.get(f"{row}_{col}", {})
        return entry["error"] if entry.get("status") == "failed" else None

    def table(self) -> DataFrame:
        """(tile_row, tile_col, status, stamp, n_roofs, error)."""
        rows = [(*map(int, key.rsplit("_", 1)), e.get("status"), e.get("stamp"), e.get("n_roofs"), e.get("error")) for key, e in self.entries.items()]
        return self.spark.createDataFrame(rows, "tile_row int, tile_col int, status string, stamp string, n_roofs long, error string")


def content_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of an artifact's files, hashed where they lie and put together by name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = files.select(F.struct(F.regexp_extract("path", r"[^/]+$", 0).alias("name"), F.sha2("content", 256).alias("sha")).alias("f"))
    return each.agg(F.sha2(F.to_json(F.array_sort(F.collect_list("f"))), 256)).first()[0]


def write_sidecar(spark: SparkSession, artifact: str, key: str) -> None:
    """Record under which key an artifact was made and what it held then; the artifact comes first."""
    _, where, fs = _fs(spark, artifact)
    if not fs.exists(where):
        raise FileNotFoundError(f"no artifact to vouch for: {artifact}")
    write_text(spark, artifact + ".key", json.dumps({"key": key, "sha256": content_hash(spark, artifact)}))


def read_sidecar(spark: SparkSession, artifact: str) -> dict[str, str] | None:
    """The record; None if it is absent, cut short or in an older plain form."""
    try:
        record = json.loads(read_text(spark, artifact + ".key") or "")
    except ValueError:
        return None
    return record if isinstance(record, dict) and all(isinstance(record.get(k), str) for k in ("key", "sha256")) else None


def sidecar_matches(spark: SparkSession, artifact: str, key: str) -> bool:
    """Whether the artifact is there, was made under this key and still holds what it held."""
    record, (_, where, fs) = read_sidecar(spark, artifact), _fs(spark, artifact)
    return record is not None and record["key"] == key and fs.exists(where) and record["sha256"] == content_hash(spark, artifact)


def adopt_sidecar(spark: SparkSession, artifact: str) -> bool:
    """Turn a plain sidecar, whose whole text is the key, into a record of the artifact as it stands; True if it did."""
    text, (_, where, fs) = read_text(spark, artifact + ".key"), _fs(spark, artifact)
    if text is None or not fs.exists(where) or read_sidecar(spark, artifact) is not None:
        return False
    write_sidecar(spark, artifact, text)
    return True


def _key(**settings) -> str:
    return json.dumps(settings, sort_keys=True)


def surface_key(row: int, col: int, resolution_m: float, source: str, version: str = SURFACE_VERSION) -> str:
    return _key(origin=list(K.GRID_ORIGIN), tile_size_m=K.TILE_SIZE_M, buffer_m=K.TILE_BUFFER_M, row=row, col=col, resolution_m=resolution_m, source=source, version=version)


def radiation_key(surface: str, days: list[int] | None, engine: str, version: str = RADIATION_VERSION, horizon: object = None) -> str:
    """Chains the surface's key; days count as a set, the engine's version must be given, the horizon's place is kept free."""
    return _key(surface=surface, days=sorted(days) if days is not None else None, engine=engine, version=version, horizon=horizon)


def scoring_key(radiation: str, source: str, method: str, version: str = SCORING_VERSION) -> str:
    return _key(radiation=radiation, source=source, method=method, version=version)


def run_label(days: list[int] | None = None, version: str = SCORING_VERSION) -> str:
    return f"{len(K.MID_MONTH_DAYS) if days is None else len(days)}day_{version}"


def check_label(label: str) -> str:
    """The label, if it is a plain folder name."""
    if not label or label in (".", "..") or "/" in label or "\\" in label:
        raise ValueError(f"a run's label must be a plain folder name: {label!r}")
    return label


def run_folder(base: str, area: str, label: str) -> str:
    return f"{base.rstrip('/')}/{area}/{check_label(label)}"


def artifact(base: str, row: int, col: int, kind: str) -> str:
    return f"{base.rstrip('/')}/tile_{row}_{col}_{kind}.parquet"


def positive_int(name: str, value: object) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ValueError(f"{name} must be a whole number of 1 or more, not {value!r}")
    return value


def parse_days(text: str | None) -> list[int] | None:
    """None or ``calibrated`` is the mid-month default; else days of the year between commas."""
    return None if text is None or text == "calibrated" else [int(d) for d in text.split(",")]


def run_city(tiles: DataFrame, score: Callable[[DataFrame], DataFrame], manifest: Manifest, stamp: str, path: str) -> DataFrame:
    """Score the tiles that aren't current and return the city, ranked anew, from all that are.

    :param score: scored buildings (tile_row, tile_col, ...) of a table of tiles (tile_row, tile_col).

    All pending tiles are one job; only if that fails is each tried alone, so that a bad tile is recorded and the others
    stand. A tile without roofs is done with none. Results are written before the manifest that vouches for them.
    """
    pending = areas.done_tiles(tiles, manifest.table(), stamp).where("not is_current").select("tile_row", "tile_col")
    todo = sorted((r["tile_row"], r["tile_col"]) for r in pending.collect())  # tiles of one city

    def attempt(some: list[tuple[int, int]]) -> None:
        part = tiles.where(F.struct("tile_row", "tile_col").isin([F.struct(F.lit(r), F.lit(c)) for r, c in some]))
        write_city(score(part), path)
        found = {(r["tile_row"], r["tile_col"]): r["n"] for r in tiles.sparkSession.read.parquet(path).where(F.struct("tile_row", "tile_col").isin([F.struct(F.lit(r), F.lit(c)) for r, c in some])).groupBy("tile_row", "tile_col").agg(F.count("*").alias("n")).collect()}
        for tile in some:
            manifest.mark_done(*tile, stamp, found.get(tile, 0))

    if todo:
        try:
            attempt(todo)
        except Exception:  # noqa: BLE001  whatever a tile's data raised
            for tile in todo:
                try:
                    attempt([tile])
                except Exception as e:  # noqa: BLE001
                    manifest.mark_failed(*tile, stamp, str(e))
        manifest.save()
    done = manifest.table().where((F.col("status") == "done") & (F.col("n_roofs") > 0)).select("tile_row", "tile_col")
    return tiles.sparkSession.read.parquet(path).join(F.broadcast(done), ["tile_row", "tile_col"], "left_semi")


def append_log(log: DataFrame, path: str) -> None:
    """Add a run's figures to its log; earlier segments stay."""
    log.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").json(path)
