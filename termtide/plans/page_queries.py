"""Registered queries of page extraction and of text parsing, on `pages` and on markup derived from the classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.functions import scalars
from termtide.plans.model import CLASSES_SQL, classes, slots, table
from termtide.sources import pages, tables
from termtide.sources.durable import stored


def page_texts(spark: SparkSession, d: str) -> DataFrame:
    return pages.html_to_text(table(spark, d, "pages")).select("page_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.length("text").alias("n_chars"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    return pages.html_links(table(spark, d, "pages"), r"^[A-Z]")


def page_tables(spark: SparkSession, d: str) -> DataFrame:
    """Each page with two tables behind it, written from its id and address, one of them empty, read back as cells."""
    p = table(spark, d, "pages")
    row = lambda *c: F.concat(F.lit("<tr>"), *(x for v in c for x in (F.lit("<td> <b>"), v, F.lit("</b>\n</td>"))), F.lit("</tr>"))
    made = F.concat(F.coalesce("html", F.lit("")), F.lit("<table><tr><td> </td></tr></table><TABLE>"), row(F.lit("page &amp; url"), F.lit("")), row(F.col("page_id").cast("string"), F.col("url")), F.lit("</TABLE>"))
    return pages.html_tables(p.withColumn("html", made)).select("page_id", "table", "row", F.array_join("cells", "|").alias("cells"))


def _cards(spark: SparkSession, d: str) -> DataFrame:
    """Result pages: one page per code and year, one card per class. The classes of a page meet where they were dealt out by part, before their cards are written."""
    c = classes(spark, d, dealt=True)
    held = ["class_id", "sbjt_cd", "lt_no", "subh_cd", "name", "grading", "professor", "department", "applied", "quota", "credits", "day_index", "start_time", "end_time", "cart", "l_suppkey"]
    hidden = lambda n, v: F.concat(F.lit(f'<input type="hidden" name="{n}" value="'), v, F.lit('">'))
    badge = lambda x: F.when(x["l_suppkey"] % 3 == 0, '<li class="state on">취소여석</li>').when(x["l_suppkey"] % 3 == 1, '<li class="state"></li>').otherwise("")
    card = lambda x: F.concat(
        F.lit('<div class="course-info-item">'), hidden("openSchyy", F.lit("1900")), hidden("sbjtCd", x["sbjt_cd"]), hidden("ltNo", x["lt_no"]), hidden("sbjtSubhCd", x["subh_cd"]), hidden("sbjtNm", x["name"]),
        F.lit('<a class="course-name">['), x["grading"], F.lit("][x]<strong> "), x["name"], F.lit("<br></strong></a>"),
        F.lit('<ul class="course-info"><li class="txt"><span>'), x["professor"], F.lit("</span><span>"), x["department"], F.lit("</span><span>z</span></li><li class='txt'><span>정원 <em>"),
        x["applied"], F.lit("/"), x["quota"], F.lit("</em></span><span>학점<em>"), x["credits"], F.lit("</em></span><span>장바구니<em>1</em></span></li>"), badge(x), F.lit("<li>"),
        F.substring(F.lit(scalars.DAYS), x["day_index"] + 1, F.lit(1)), F.lit("("), x["start_time"], F.lit("~"), x["end_time"], F.lit(")</li></ul>"),
        F.when(x["cart"].isNotNull(), F.concat(F.lit('<span class="carts"><em></em> '), x["cart"], F.lit("</span>"))).otherwise(""), F.lit("</div>"),
    )
    met = c.groupBy("l_partkey", "sbjt_cd", "year").agg(F.array_sort(F.collect_list(F.struct(*held))).alias("met"), (F.count(F.lit(1)) + F.max((F.col("l_suppkey") % 50 == 0).cast("int"))).alias("total"))
    head = F.concat(F.lit('<input id="srchOpenSchyy" value="'), "year", F.lit('"><div class="search-result-con"><small><em>'), "total", F.lit("</em></small>"))
    page = F.expr("substring(sbjt_cd, 2)").cast("long") * 10_000 + F.col("year")
    return met.select(page.alias("page_id"), F.concat(head, F.array_join(F.transform("met", card), "\n")).alias("html"))


def result_cards(spark: SparkSession, d: str) -> DataFrame:
    out = pages.extract_cards(_cards(spark, d))
    slot = F.get("slots", 0)
    return out.select(
        "page_id", "year", "sbjt_cd", "lt_no", "name", "professor", "department", "applied", "quota", "credits", "cart", "cancel_vacancy",
        F.array_join("classification", ",").alias("tags"), F.concat_ws(" ", slot["day_index"], slot["period"], slot["start_time"], slot["end_time"]).alias("slot"),
    )


def pages_complete(spark: SparkSession, d: str) -> DataFrame:
    cards = stored(pages.extract_cards(_cards(spark, d), fields=False).select("page_id", "total"))
    return pages.check_complete(cards, cards.select("page_id", "total"), ["page_id"])


def rosters_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Sheet rows written from the classes and all their meetings, parsed again."""
    s = slots(spark, d)
    one = F.struct("day_index", "start_time", "end_time", "room")
    day = lambda x: F.substring(F.lit(scalars.DAYS), x["day_index"] + 1, F.lit(1))
    text = s.groupBy("class_id").agg(F.array_sort(F.collect_set(one)).alias("m")).select(
        "class_id", F.array_join(F.transform("m", lambda x: F.concat(day(x), F.lit("("), x["start_time"], F.lit("~"), x["end_time"], F.lit(")"))), "/").alias("times"),
        F.array_join(F.transform("m", lambda x: F.concat(x["room"], F.lit("(무선랜제공)"))), "/").alias("rooms"))
    c = classes(spark, d).join(text, "class_id")
    raw = c.select(
        F.when(F.col("l_suppkey") % 17 == 0, " ").otherwise(F.col("sbjt_cd")).alias("code"), F.when(F.col("lt_no") == "001", "").otherwise(F.col("lt_no")).alias("lecture"), "name",
        F.when(F.col("l_suppkey") % 2 == 0, F.col("name")).otherwise(F.col("grade")).alias("subtitle"), F.get("classification", 0).alias("tag_a"), F.lit(" ").alias("tag_b"), F.concat("credits", F.lit(".0")).alias("credits"),
        F.concat("quota", F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit(" ("), F.col("quota") - 1, F.lit(")"))).otherwise("")).alias("quota"), "times", "rooms",
    )
    out = tables.normalize_roster(raw)
    shown = F.array_join(F.transform("slots", lambda x: F.concat_ws(" ", x["day_index"], x["period"], x["start_time"], x["end_time"], x["room"])), ";")
    return out.select("sbjt_cd", "lt_no", "name", F.array_join("classification", ",").alias("tags"), "credits", "quota", "quota_returning", "room", shown.alias("slots"), scalars.slot_text("slots").alias("text"))


def attachments_parsed(spark: SparkSession, d: str) -> DataFrame:
    """One response per customer, with a Korean file, an English one, both or none."""
    c = table(spark, d, "customer")
    entry = F.struct(
        F.lit(0).alias("rowIdx"), F.col("c_name").alias("korFileNm"), F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(".en"))).otherwise(" ").alias("engFileNm"),
        F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("K"), "c_custkey")).alias("korAttachNo"), F.concat(F.lit("E"), "c_custkey").alias("engAttachNo"),
        F.when(F.col("c_custkey") % 5 == 0, F.col("c_nationkey")).alias("korAttachDetaNo"), F.col("c_nationkey").alias("engAttachDetaNo"))
    made = F.when(F.col("c_custkey") % 7 > 0, F.to_json(F.struct(F.array(entry).alias("LISTTAB03_LIST_ATTACH")))).otherwise('{"LISTTAB03_LIST_ATTACH":null}')
    return tables.parse_attachments(c.select("c_custkey", made.alias("json")))


QUERIES = {f.__name__: f for f in (page_texts, page_links, page_tables, result_cards, pages_complete, rosters_normalised, attachments_parsed)}

#: The named entities of these pages; the ampersand comes last, as one pass would have it.
_UNESCAPE = "replace(replace(replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', ''''), '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&amp;', '&')"
_TEXT = "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', ' ', 'g')"
for _pattern, _by in (("(?is)<style\\b.*?</style\\s*>", " "), ("(?i)</(td|th)>", " | "), ("(?i)</(tr|p|div|li|h[1-6])>", "\n"), ("<[^>]+>", " ")):
    _TEXT = f"regexp_replace({_TEXT}, '{_pattern}', '{_by}', 'g')"
ORACLE_SQL = {
    "page_texts": f"WITH t AS (SELECT page_id, {_UNESCAPE.format(_TEXT)} AS x FROM pages), l AS (SELECT page_id, list_filter(list_transform(list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\\s]')), lambda s: trim(regexp_replace(s, '[ \\t]+', ' ', 'g'))), lambda s: true) AS ls FROM t) SELECT page_id, sha256(array_to_string(ls, chr(10))) AS text_sha256, length(array_to_string(ls, chr(10)))::INTEGER AS n_chars FROM l",
    "page_links": f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">'), 1) AS i FROM pages),
b AS (SELECT page_id, i, regexp_extract(url, '^[a-z]+://[^/?#]+') || {_UNESCAPE.format('h')} AS href, {_UNESCAPE.format('t')} AS text FROM a WHERE regexp_matches({_UNESCAPE.format('t')}, '^[A-Z]')),
f AS (SELECT page_id, href, arg_min(text, i) AS text, min(i) AS i FROM b GROUP BY page_id, href) SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INTEGER AS place, href, text FROM f""",
    "page_tables": "SELECT page_id, 0 AS \"table\", 0 AS row, 'page & url|' AS cells FROM pages UNION ALL SELECT page_id, 0, 1, page_id || '|' || url FROM pages",
    "result_cards": f"""WITH {CLASSES_SQL} SELECT substr(sbjt_cd, 2)::BIGINT * 10000 + year AS page_id, year::VARCHAR AS year, sbjt_cd, lt_no, name, professor, department, applied, quota, credits, coalesce(cart, 1) AS cart,
CASE l_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS cancel_vacancy, grading || ',x' AS tags, day_index || ' ' || period || ' ' || start_time || ' ' || end_time AS slot FROM classes""",
    "pages_complete": f"WITH {CLASSES_SQL} SELECT substr(sbjt_cd, 2)::BIGINT * 10000 + year AS page_id, (count(*) + max((l_suppkey % 50 = 0)::INTEGER))::INTEGER AS total, count(*) AS fetched, max((l_suppkey % 50 = 0)::INTEGER) = 0 AS ok FROM classes GROUP BY sbjt_cd, year",
    "rosters_normalised": f"""WITH {CLASSES_SQL}, m AS (SELECT class_id, string_agg(day_index || ' ' || period || ' ' || start_time || ' ' || end_time || ' ' || room, ';' ORDER BY day_index, start_time, end_time, room) AS slots,
  string_agg(substr('월화수목금토일', day_index + 1, 1) || start_time || '~' || end_time, '/' ORDER BY day_index, start_time, end_time) AS text,
  array_to_string(list_transform(list_sort(list_distinct(list((day_index || start_time || end_time || room, room)))), lambda x: x[2]), '/') AS allrooms, list(room ORDER BY day_index, start_time, end_time, room) AS rs FROM slots GROUP BY class_id)
SELECT sbjt_cd, lt_no, CASE WHEN l_suppkey % 2 = 0 THEN name ELSE name || ' (' || grade || ')' END AS name, classification[1] AS tags, credits::BIGINT AS credits, quota, CASE WHEN l_suppkey % 3 = 0 THEN quota - 1 END AS quota_returning,
  array_to_string(list_filter(rs, lambda r, i: list_position(rs, r) = i), '/') AS room, slots, text FROM classes JOIN m USING (class_id) WHERE l_suppkey % 17 <> 0""",
    "attachments_parsed": "WITH c AS (SELECT * FROM customer WHERE c_custkey % 7 > 0) SELECT c_custkey, 'ko' AS lang, c_name AS name, 'K' || c_custkey AS file_no, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey ELSE 0 END AS detail_no FROM c WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'en', c_name || '.en', 'E' || c_custkey, c_nationkey FROM c WHERE c_custkey % 2 = 0",
}
