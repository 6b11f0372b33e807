"""Record files, auxiliary documents and sinks."""

from __future__ import annotations

import hashlib
import json

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import stripped

# Where a line of an auxiliary file may keep its text, in this order.
TEXT_FIELDS = ("text", "content", "body", "prompt", "description")
ENDINGS = (".txt", ".md", ".jsonl")


class SourceError(ValueError):
    pass


def read_records(spark: SparkSession, path: str, schema: str, unique: str | None = "id", required: tuple[str, ...] = ()) -> DataFrame:
    """A file of JSON lines; lines end at \\n only. Bad lines, missing fields, repeated ids and an empty file are errors."""
    lines = spark.read.text(path, lineSep="\n").where(stripped(F.col("value")) != "")
    rows = lines.select(F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*")
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | (F.coalesce(stripped(F.col(c).cast("string")), F.lit("")) == "")
    seen = rows.agg(F.count("*").alias("n"), F.count("_bad").alias("bad"), F.count_if(lacking).alias("lacking")).first()
    if not seen.n or seen.bad or seen.lacking:
        raise SourceError(f"{seen.n} rows in {path}, {seen.bad} aren't JSON objects, {seen.lacking} lack a field")
    if unique:
        twice = rows.groupBy(unique).agg(F.count("*").alias("n")).where("n > 1").orderBy(unique).limit(5).collect()
        if twice:
            raise SourceError(f"repeated {unique}: {[r[0] for r in twice]}")
    return rows.drop("_bad")


def write_records(df: DataFrame, path: str) -> str:
    """Writes JSON lines, committed as a whole, and returns a digest of what was written, whatever its files and order."""
    df.write.mode("overwrite").json(path)
    df = df.sparkSession.read.schema(df.schema).json(path)
    whole = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    sums = [F.sum(F.conv(F.substring(whole, 1 + 8 * k, 8), 16, 10).cast("long")) for k in range(8)]
    row = df.agg(F.count("*"), *sums).first()
    return hashlib.sha256(json.dumps(list(map(int, (x or 0 for x in row)))).encode()).hexdigest()


def file_digest(spark: SparkSession, path: str) -> str | None:
    """SHA-256 of a small file's bytes, through Spark's reader; null if it can't be read."""
    try:
        found = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d")).take(2)
    except (AnalysisException, Py4JError):
        return None
    return found[0].d if len(found) == 1 else None


def aux_text(line: str) -> str:
    """Text of one line of an auxiliary JSON file: its first text field, a bare string, or the line as it is."""
    try:
        value = json.loads(line)
    except ValueError:
        return line.strip()
    if isinstance(value, str):
        return value.strip()
    if isinstance(value, dict):
        found = next((v.strip() for v in map(value.get, TEXT_FIELDS) if isinstance(v, str) and v.strip()), None)
        return found or json.dumps(value, ensure_ascii=False)
    return line.strip()


def load_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, text, ordinal) of the auxiliary files that hold any text, in the given order."""
    rows = []
    for k, path in enumerate(paths):
        name = path.rsplit("/", 1)[-1]
        if not name.endswith(ENDINGS):
            raise SourceError(f"{name}: only {', '.join(ENDINGS)} are read")
        first = spark.read.text(path, wholetext=True).first()
        text = first.value if first else ""
        if name.endswith(".jsonl"):
            text = "\n".join(filter(None, (aux_text(x) for x in text.split("\n") if x.strip())))
        if text.strip():
            rows.append((name, text.strip(), k))
    return spark.createDataFrame(rows, "name string, text string, ordinal int")
