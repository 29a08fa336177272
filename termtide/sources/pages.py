"""Extraction from a pages table: narrow, vectorised, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from termtide.functions import markup

SLOT = "struct<day_index:int,period:int,start_time:string,end_time:string>"
CARD = (
    "year string, shtm_fg string, deta_shtm_fg string, sbjt_cd string, lt_no string, subh_cd string, name string, classification array<string>, professor string, department string, "
    f"applied int, quota int, enrolled int, credits int, cart int, cancel_vacancy int, slots array<{SLOT}>"
)


def _each(pages: DataFrame, cols: list[str], work: Callable[..., list[tuple]], schema: str) -> DataFrame:
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [row for values in zip(*(b.column(c).to_pylist() for c in cols)) for row in work(*values)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(zip(*rows), kinds.types)], schema=kinds)

    return pages.select(*cols).mapInArrow(run, schema)


def _text(value) -> str:
    return value if isinstance(value, str) else ""


def html_to_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text); null markup gives ''."""

    @F.pandas_udf(T.StringType())
    def convert(col: pd.Series) -> pd.Series:
        return col.map(lambda m: markup.plain_text(_text(m)))

    return pages.select(id_col, convert(html_col).alias("text"))


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, table, row, cells)."""
    work = lambda i, m: [(i, t, r, cells) for t, rows in enumerate(markup.tables(_text(m))) for r, cells in enumerate(rows)]
    kind = pages.schema[id_col].dataType.simpleString()
    return _each(pages, [id_col, html_col], work, f"{id_col} {kind}, table int, row int, cells array<string>")


def html_links(pages: DataFrame, pattern: str = ".", id_col: str = "page_id", html_col: str = "html", base_col: str = "url") -> DataFrame:
    """(id, place, href, text) of links whose text fits, resolved against the page's address."""
    work = lambda i, m, b: [(i, n, h, t) for n, (h, t) in enumerate(markup.links(_text(m), _text(b), pattern))]
    kind = pages.schema[id_col].dataType.simpleString()
    return _each(pages, [id_col, html_col, base_col], work, f"{id_col} {kind}, place int, href string, text string")


def extract_cards(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fields: bool = True) -> DataFrame:
    """(id, place, reported total, card columns) of every result card; pages without cards give no rows. fields: with the card columns."""

    def work(i, m):
        total, found = markup.cards(_text(m), fields)
        return [(i, n, total, *card.values()) for n, card in enumerate(found)]

    kind = pages.schema[id_col].dataType.simpleString()
    return _each(pages, [id_col, html_col], work, f"{id_col} {kind}, place int, total int" + (f", {CARD}" if fields else ""))


def check_complete(cards: DataFrame, totals: DataFrame, scope: list[str]) -> DataFrame:
    """(scope, fetched, total, ok): a term with fewer rows than its largest reported total is not complete; total 0 is."""
    n = cards.groupBy(*scope).agg(F.count(F.lit(1)).alias("fetched"))
    out = totals.groupBy(*scope).agg(F.max("total").alias("total")).join(n, scope, "left").withColumn("fetched", F.coalesce("fetched", F.lit(0)))
    return out.withColumn("ok", F.col("fetched") >= F.col("total"))
