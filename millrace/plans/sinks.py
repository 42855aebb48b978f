"""Writers of stages and exports."""

from __future__ import annotations

import contextlib
import hashlib
import json
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import hadoop_path, write_text


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, nulls written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path, "append")


def as_json(data: dict) -> str:
    return json.dumps(data, indent=2, ensure_ascii=False, default=str)


def write_json(path: str, data: dict) -> None:
    """A small report, from the driver."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(as_json(data), encoding="utf-8")


def flat(df: DataFrame) -> DataFrame:
    """``metadata`` as a JSON string, for formats without nesting."""
    return df.withColumn("metadata", F.to_json("metadata")) if "metadata" in df.columns else df


def _jsonl(df: DataFrame, path: str) -> None:
    write_jsonl(df, path)


def _parquet(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").parquet(path)


def _csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').option("multiLine", True).csv(path)


@contextlib.contextmanager
def _put(spark: SparkSession, path: str) -> Iterator[str]:
    """A local path to write, which is then moved to ``path`` on whatever file system that names."""
    with tempfile.TemporaryDirectory() as here:
        local = f"{here}/{Path(path).name}"
        yield local
        (fs, where), (_, source) = hadoop_path(spark, path), hadoop_path(spark, f"file://{local}")
        fs.delete(where, True)
        fs.mkdirs(where.getParent())
        fs.copyFromLocalFile(True, True, source, where)


def _arrow(df: DataFrame, path: str) -> None:
    """One Feather file, written by the driver: for exports that fit it."""
    from pyarrow import feather

    with _put(df.sparkSession, path) as local:
        feather.write_feather(flat(df).toArrow(), local)


def _feature(kind) -> dict:
    """An Arrow type in the words of a dataset folder."""
    import pyarrow as pa

    if pa.types.is_struct(kind):
        return {kind.field(k).name: _feature(kind.field(k).type) for k in range(kind.num_fields)}
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return {"feature": _feature(kind.value_type), "_type": "List"}
    names = {"double": "float64", "float": "float32"}
    return {"dtype": names.get(str(kind), str(kind)), "_type": "Value"}


def _dataset_dir(df: DataFrame, path: str) -> None:
    """One split of a dataset folder: an Arrow stream, nested metadata and its description."""
    import pyarrow as pa

    table, name = df.toArrow(), "data-00000-of-00001.arrow"
    features = {x.name: _feature(x.type) for x in table.schema}
    told = hashlib.sha256(repr((features, table.num_rows, table.nbytes)).encode()).hexdigest()[:16]
    state = {"_data_files": [{"filename": name}], "_fingerprint": told, "_format_columns": None, "_format_kwargs": {}, "_format_type": None, "_output_all_columns": False}
    with _put(df.sparkSession, path) as local:
        write_json(f"{local}/dataset_info.json", {"citation": "", "description": "", "features": features, "homepage": "", "license": ""})
        write_json(f"{local}/state.json", state | {"_split": Path(path).name})
        with pa.OSFile(f"{local}/{name}", "wb") as f, pa.ipc.new_stream(f, table.schema) as w:
            w.write_table(table)


#: Format name to (suffix, writer).
FORMATS: dict[str, tuple[str, Callable[[DataFrame, str], None]]] = {
    "jsonl": ("jsonl", _jsonl), "parquet": ("parquet", _parquet), "csv": ("csv", _csv), "arrow": ("arrow", _arrow), "hf_dataset": ("", _dataset_dir),
}


SPLITS = ("train", "validation")


def export(df: DataFrame, folder: str, name: str, formats: list[str]) -> list[str]:
    """Write rows by their ``split`` in each format; the paths written."""
    paths = []
    for fmt in formats:
        suffix, writer = FORMATS[fmt]
        for split in SPLITS:
            path = f"{folder}/{name}.{split}.{suffix}" if suffix else f"{folder}/{name}_hf/{split}"
            writer(df.where(F.col("split") == split).drop("split"), path)
            paths.append(path)
        if not suffix:
            write_text(df.sparkSession, f"{folder}/{name}_hf/dataset_dict.json", as_json({"splits": list(SPLITS)}))
    return paths
