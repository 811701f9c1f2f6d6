"""Fill-in-middle transformation by rotating blocks in place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm.texts import blocks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 texts so many are transformed, and of 100 transformed ones so many start with the suffix.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = "1"

OUTPUT = "form string, prefix_chars long, middle_chars long, output string"


def rotate(block: np.ndarray, first: int) -> None:
    """Exchange ``block[:first]`` and ``block[first:]`` in place: reverse both, then the whole."""
    block[:first] = block[:first][::-1]
    block[first:] = block[first:][::-1]
    block[:] = block[::-1]


def insert(buffer: bytearray, at: int, sentinel: bytes) -> None:
    buffer[at:at] = sentinel


@dataclass(frozen=True)
class Plan:
    """What becomes of one text: its form and the code points at which it is cut."""

    form: str
    first: int = 0
    second: int = 0


def plan(doc_id: int | None, text: bytes, n: int, transformed: int, suffix_first: int, seed: str) -> Plan:
    """Form and cuts of a text of ``n`` code points, drawn from a hash of the document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    draws = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    marked = any(sentinel in text for sentinel in (PREFIX, SUFFIX, MIDDLE))
    if n == 0 or marked or draws[2] % 100 >= transformed:
        return Plan(PLAIN)
    cuts = sorted(draw % (n + 1) for draw in draws[:2])
    return Plan(SPM if draws[3] % 100 < suffix_first else PSM, *cuts)


def code_points(text: np.ndarray) -> np.ndarray:
    """The places at which code points start in UTF-8 bytes, and the end of the text."""
    return np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))


def transform(text: bytes, form: str, first: int, second: int) -> bytes:
    """The text with sentinels, its segments in the order of ``form``; cuts are byte places."""
    if form == PLAIN:
        return text
    buffer = bytearray(text)
    # from the last cut to the first, so that earlier places stay right
    insert(buffer, second, SUFFIX)
    insert(buffer, first, MIDDLE)
    insert(buffer, 0, PREFIX)
    first, second = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    bytes_ = np.frombuffer(buffer, np.uint8)
    if form == PSM:  # prefix, (middle, suffix) exchanged
        rotate(bytes_[first:], second - first)
    else:  # (prefix, middle) exchanged with the suffix
        rotate(bytes_, second)
    return bytes_.tobytes()


def inverse(output: bytes, form: str) -> bytes:
    """The text :func:`transform` was given.

    A sentinel cannot arise where a text meets an inserted one, as each starts with ``<`` and ends
    with ``>``; so in an output that isn't plain each sentinel stands exactly once.
    """
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    bytes_ = np.frombuffer(buffer, np.uint8)
    if form == PSM:
        start = output.index(SUFFIX)
        middle = output.index(MIDDLE) - start
        rotate(bytes_[start:], middle)
        places = [0, start, start + len(output) - start - middle]
    else:
        start = output.index(PREFIX)
        middle = output.index(MIDDLE) - start
        rotate(bytes_, start)
        places = [0, middle, len(output) - start]
    del bytes_  # a bytearray with a view on it cannot shrink
    for place in reversed(places):
        del buffer[place : place + len(PREFIX)]
    return bytes(buffer)


def _texts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[start:end]


def fill_in_middle(
    docs: DataFrame,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    A text is cut at two places drawn from a hash of ``seed`` and ``doc_id``; equal ids are cut alike
    wherever their lengths agree.  ``transformed`` of 100 texts take the forms psm
    (``<P>prefix<S>suffix<M>middle``) and, ``suffix_first`` of 100 of these, spm
    (``<S>suffix<P>prefix<M>middle``).  Others are plain, as are empty texts and texts that hold a sentinel;
    their chars are null.  A null text counts as empty, a null id as an empty one; each row
    gives one row, repeated rows too, an empty table none.  Other columns are not read.  Rows
    are handled where they lie: nothing is shuffled.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc_id, view in zip(ids, _texts(data, offsets), strict=True):
                starts, text = code_points(view), view.tobytes()
                n = len(starts) - 1
                made = plan(doc_id, text, n, transformed, suffix_first, seed)
                output = transform(
                    text, made.form, int(starts[made.first]), int(starts[made.second])
                )
                chars = (None, None) if made.form == PLAIN else (made.first, made.second - made.first)
                rows.append((n, made.form, *chars, output))
            n, form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(form, pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64()),
                    "middle_chars": pa.array(middle, pa.int64()),
                    "output": pa.array(output, pa.binary()).cast(pa.string()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, f"doc_id long, n long, {OUTPUT}")


def restore(outputs: DataFrame, column: str = "restored") -> DataFrame:
    """Add the exact text from which ``output`` was made, found from ``output`` and ``form`` alone."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches, column="output"):
            forms = batch.column("form").to_pylist()
            texts = [
                inverse(view.tobytes(), form)
                for form, view in zip(forms, _texts(data, offsets), strict=True)
            ]
            yield batch.append_column(column, pa.array(texts, pa.binary()).cast(pa.string()))

    schema = T.StructType([*outputs.schema.fields, T.StructField(column, T.StringType())])
    return outputs.mapInArrow(back, schema)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all transformed documents and of the texts restored from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return restore(fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored")
    )


QUERIES = {"op13_infill": op13_infill}

SQL = {
    "op13_infill": """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), draws AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
    ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM texts
), cuts AS (
  SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) AS q,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90
      THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM draws
), parts AS (
  SELECT *, substring(t, 1, p) AS prefix, substring(t, p + 1, q - p) AS middle,
    substring(t, q + 1, n - q) AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
}
