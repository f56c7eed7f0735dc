"""Terrain tiles by role: heights, normals, layer indices and layer weights, each a square binary grid of its own cell.

One schema says what each role's cells are and which statistics they have; a dispatcher decodes a tile by its role.  A second check
tells from the size alone which roles a tile could have, and shares nothing with the first."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.sources.records import terrain_files


def heights(cells: np.ndarray) -> dict[str, float]:
    finite = np.isfinite(cells)
    known = cells[finite].astype(np.float64)
    some = {"low": float(known.min()), "high": float(known.max()), "sum": math.fsum(known)} if len(known) else {}
    return {**some, "not_finite": float((~finite).sum())}


def normals(cells: np.ndarray) -> dict[str, float]:
    """Ranges of the three components; the fourth byte marks seams, which belong to the last row and column."""
    side = math.isqrt(len(cells))
    place = np.flatnonzero(cells[:, 3])
    last = (place % side == side - 1) | (place // side == side - 1)
    ranges = {f"{c}_{k}": float(f(cells[:, i])) for i, c in enumerate("xyz") for k, f in (("low", np.min), ("high", np.max))} if len(cells) else {}
    return {**ranges, "seam": float(len(place)), "seam_on_edge": float(last.sum())}


def indices(cells: np.ndarray) -> dict[str, float]:
    return {"layers": float(len(np.unique(cells[:, :3]))), "alpha_off": float((cells[:, 3] != 255).sum())}


def weights(cells: np.ndarray) -> dict[str, float]:
    total = cells[:, :3].astype(np.int32).sum(axis=1)
    return {"over": float((total > 255).sum()), "alpha_off": float((cells[:, 3] != 255).sum())}


#: Role: (type of a cell's parts, parts of a cell, statistics).
ROLES: dict[str, tuple[str, int, Callable[[np.ndarray], dict[str, float]]]] = {"h": ("<f4", 1, heights), "n": ("u1", 4, normals), "i": ("u1", 4, indices), "w": ("u1", 4, weights)}


def tile_stats(role: str, content: bytes) -> tuple[int | None, dict[str, float], str | None]:
    """(side, statistics, problem) of a tile."""
    kind, parts, stats = ROLES[role]
    cell = np.dtype(kind).itemsize * parts
    side = math.isqrt(len(content) // cell)
    if side * side * cell != len(content):
        return None, {}, f"{len(content)} bytes are no square of cells of {cell}"
    cells = np.frombuffer(content, kind)
    return side, stats(cells.reshape(-1, parts) if parts > 1 else cells), None


def terrain_stats(files: DataFrame) -> DataFrame:
    """(path, dir, tx, ty, role, side, stats, problem) of files (path, length, content) whose names say a tile and role; stats maps
    the names of the role's statistics to numbers.  A tile is decoded by itself; other names are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.float64())
        for batch in batches:
            rows = [tile_stats(role, data.as_py() or b"") for role, data in zip(batch.column("role").to_pylist(), batch.column("content"))]
            side, stats, problem = zip(*rows) if rows else ((), (), ())
            keys = [batch.column(c) for c in ("path", "dir", "tx", "ty", "role")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(side, pa.int32()), pa.array([list(s.items()) for s in stats], kind), pa.array(problem, pa.string())], names=["path", "dir", "tx", "ty", "role", "side", "stats", "problem"])

    return terrain_named(files).mapInArrow(work, "path string, dir string, tx int, ty int, role string, side int, stats map<string,double>, problem string")


def terrain_named(files: DataFrame) -> DataFrame:
    """files (path, length, content, ...) of terrain tiles with what their names say."""
    return terrain_files(files.select("path", F.struct("length", "content").alias("length")), "".join(ROLES)).select("path", "dir", "tx", "ty", "role", "length.content")


def scene_stats(tiles: DataFrame) -> DataFrame:
    """(dir, tiles, broken, low, high, mean): heights of each folder, from terrain_stats."""
    h = F.col("role") == "h"
    at = lambda k: F.when(h, F.try_element_at("stats", F.lit(k)))
    cells = F.when(h, F.col("side") * F.col("side") - F.try_element_at("stats", F.lit("not_finite")))
    return tiles.groupBy("dir").agg(F.count("*").alias("tiles"), F.count_if(F.col("problem").isNotNull()).alias("broken"), F.min(at("low")).alias("low"), F.max(at("high")).alias("high"), (F.sum(at("sum")) / F.nullif(F.sum(cells), F.lit(0))).alias("mean"))


def disagreeing_tiles(tiles: DataFrame, files: DataFrame) -> DataFrame:
    """(path, side, measured) of tiles whose side is not what their length says, taken from the file's size by another way."""
    measured = files.select(F.col("path").alias("_path"), F.sqrt(F.col("length") / 4.0).alias("measured"))
    both = tiles.join(measured, F.col("path") == F.col("_path"))
    return both.where(~F.coalesce(F.col("side").cast("double"), F.lit(-1.0)).eqNullSafe(F.when(F.col("measured") == F.floor("measured"), F.col("measured")).otherwise(F.lit(-1.0)))).select("path", "side", "measured")
