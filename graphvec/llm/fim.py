"""Fill-in-middle transformation: DuckDB SQL over Arrow batches, inside mapInArrow.

A task registers one piece of a batch at a time in its own in-memory DuckDB and runs one
statement: regexp_extract_all cuts a text into units, sha256 of seed and id gives the cuts and
the form, list_slice and array_to_string put the parts together.  No Python code sees a row, no
row leaves its task, and memory is bounded by PIECE_BYTES or by one text, if that is longer.
`restore` is the inverse, from output and form alone: a text that holds a marker stays plain, so
each marker of an output stands there once.

Edge cases: a null text is empty; an empty text, and one with a marker, is plain; a null doc_id
is hashed as an empty one; repeated rows give equal rows; white space alone is one unit; texts
of any length are taken whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
RATE = 50  # texts in a hundred that are transformed
SUFFIX_FIRST = 80  # of these in a hundred
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PIECE_BYTES = 4 << 20
MEMORY = "1GB"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

TRANSFORM = r"""
WITH cut AS (
  SELECT doc_id, text, regexp_extract_all(text, $unit) AS units, sha256($seed || ':' || coalesce(doc_id::VARCHAR, '')) AS h FROM piece
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM cut
), placed AS (
  SELECT doc_id, text, units, n, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN n = 0 OR contains(text, $p) OR contains(text, $s) OR contains(text, $m) OR h3 % 100 >= $rate THEN 'plain' WHEN h4 % 100 < $first THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, 1, a), '') END AS prefix,
    CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, a + 1, b), '') END AS middle, CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, b + 1, n), '') END AS suffix FROM placed
)
SELECT doc_id, n::BIGINT AS n, form, length(prefix)::BIGINT AS prefix_chars, length(middle)::BIGINT AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN $p || prefix || $s || suffix || $m || middle ELSE $s || suffix || $p || prefix || $m || middle END AS output FROM parts"""

RESTORE = """
WITH cut AS (
  SELECT *, CASE form WHEN 'psm' THEN string_split(substr(output, length($p) + 1), $s) WHEN 'spm' THEN string_split(substr(output, length($s) + 1), $p) END AS x FROM piece
), parts AS (
  SELECT *, string_split(x[2], $m) AS y FROM cut
)
SELECT doc_id, n, form, prefix_chars, middle_chars, output,
  CASE form WHEN 'psm' THEN x[1] || y[2] || y[1] WHEN 'spm' THEN y[1] || y[2] || x[1] ELSE output END AS restored FROM parts"""


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.Table]:
    """The batches in pieces of at most `most` bytes of `column`, which has no null, or of one row."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield pa.Table.from_batches([b.slice(at, to - at)])
            at = to


def run_sql(rows: DataFrame, sql: str, schema: str, heavy: str, parameters: dict) -> DataFrame:
    """`sql` over each piece of `rows`, which it knows as the table `piece`."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        for piece in pieces(batches, heavy):
            con.register("piece", piece)
            yield from con.sql(sql, params=parameters).to_arrow_table().cast(arrow).to_batches()
            con.unregister("piece")
        con.close()

    return rows.mapInArrow(run, schema)


def transform(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of `docs`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return run_sql(rows, TRANSFORM, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string", "text",
                   {"unit": UNIT, "seed": str(seed), "p": PREFIX, "s": SUFFIX, "m": MIDDLE, "rate": rate, "first": suffix_first})


def restore(transformed: DataFrame) -> DataFrame:
    """`transformed` with the text that its output and form stand for, as `restored`."""
    kind = transformed.schema["doc_id"].dataType.simpleString()
    rows = transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return run_sql(rows, RESTORE, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string", "output", {"p": PREFIX, "s": SUFFIX, "m": MIDDLE})
