"""Queries over lines and stanzas, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS, strip
from ..operators import segments
from ..session import table


def poems(spark, d):
    return table(spark, d, "source_records")


def line_index(spark, d):
    return segments.line_index(poems(spark, d), "poem_id", "original_poem")


def translation_line_index(spark, d):
    return segments.line_index(poems(spark, d), "poem_id", "translated_poem")


def stanza_blocks(spark, d):
    return segments.stanzas(poems(spark, d), "poem_id", "original_poem")


def raw_stanza_parts(spark, d):
    return segments.raw_stanzas(poems(spark, d), "poem_id", "original_poem")


def title_line_dropped(spark, d):
    p = segments.without_title_line(poems(spark, d), "original_poem", "poem_title", "body")
    return p.select("poem_id", "body")


def prompt_lines(spark, d):
    p = poems(spark, d)
    return p.select("poem_id", segments.rendering(F.col("original_poem")).alias("source_lines"), segments.rendering(F.col("translated_poem"), "T").alias("target_lines"))


def prompt_stanzas(spark, d):
    return poems(spark, d).select("poem_id", segments.stanza_rendering(F.col("original_poem")).alias("blocks"))


def alignment_status(spark, d):
    return segments.stanza_alignment(poems(spark, d), "poem_id", "original_poem", "translated_poem")


def alignment_summary(spark, d):
    a = alignment_status(spark, d).join(poems(spark, d).select("poem_id", F.lower(strip(F.col("language"))).alias("language")), "poem_id")
    return a.groupBy("language", "status").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("mean_confidence"))


def line_statistics(spark, d):
    return line_index(spark, d).groupBy("poem_id").agg(
        F.max("line_number").alias("n_lines"), F.max("stanza_index").alias("n_stanzas"), F.sum(F.char_length("line_text")).alias("n_chars"),
        F.sum((strip(F.col("line_text")) != F.col("line_text")).cast("long")).alias("n_outer_space"),
    )


QUERIES = {f.__name__: f for f in (
    line_index, translation_line_index, stanza_blocks, raw_stanza_parts, title_line_dropped, prompt_lines, prompt_stanzas,
    alignment_status, alignment_summary, line_statistics,
)}


def lines_cte(text: str, name: str = "li") -> str:
    return f"""
{name}_raw AS (SELECT poem_id, unnest(string_split(regexp_replace({text}, '\\r\\n?', chr(10), 'g'), chr(10))) AS line_text,
    generate_subscripts(string_split(regexp_replace({text}, '\\r\\n?', chr(10), 'g'), chr(10)), 1) - 1 AS position FROM source_records WHERE {text} IS NOT NULL),
{name}_kept AS (SELECT *, row_number() OVER (PARTITION BY poem_id ORDER BY position) AS line_number,
    lag(position) OVER (PARTITION BY poem_id ORDER BY position) AS before FROM {name}_raw WHERE NOT regexp_full_match(line_text, '{WS}*')),
{name} AS (SELECT poem_id, line_number, position, line_text, sum(CASE WHEN before IS NULL OR before < position - 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY poem_id ORDER BY position) AS stanza_index FROM {name}_kept)"""




def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def key(x: str) -> str:
    return stripped(f"regexp_replace(lower({x}), '{WS}+', ' ', 'g')")



SRC, TGT = lines_cte("original_poem"), lines_cte("translated_poem", "ti")
SIZES = f"""
s AS (SELECT poem_id, stanza_index AS k, sum(length({stripped('line_text')})) AS n FROM li GROUP BY ALL),
t AS (SELECT poem_id, stanza_index AS k, sum(length({stripped('line_text')})) AS n FROM ti GROUP BY ALL),
ns AS (SELECT poem_id, count(*) AS n_source FROM s GROUP BY ALL), nt AS (SELECT poem_id, count(*) AS n_target FROM t GROUP BY ALL),
pr AS (SELECT s.poem_id, avg(least(s.n, t.n) / greatest(s.n, t.n)) AS length_score FROM s JOIN t USING (poem_id, k) GROUP BY ALL),
al AS (SELECT p.poem_id, coalesce(n_source, 0) AS n_source, coalesce(n_target, 0) AS n_target,
    greatest(0.0::double, 1 - abs(coalesce(n_source, 0) - coalesce(n_target, 0)) / greatest(coalesce(n_source, 0), 1)) AS count_score,
    coalesce(length_score, 0.0::double) AS length_score
    FROM source_records p LEFT JOIN ns USING (poem_id) LEFT JOIN nt USING (poem_id) LEFT JOIN pr USING (poem_id)),
af AS (SELECT poem_id, n_source, n_target, round(count_score, 6) AS count_score, round(length_score, 6) AS length_score,
    round(0.4::double * count_score + 0.2::double * length_score + 0.4::double * length_score, 4) AS confidence FROM al),
ag AS (SELECT *, CASE WHEN confidence < 0.6 OR abs(n_source - n_target) > 1 THEN 'alignment_risk'
    WHEN n_source = n_target AND confidence >= 0.75 THEN 'aligned' ELSE 'aligned_low' END AS status FROM af)"""

SQL = {
    "line_index": f"WITH {SRC} SELECT poem_id, line_number, position, stanza_index, line_text FROM li",
    "translation_line_index": f"WITH {TGT} SELECT poem_id, line_number, position, stanza_index, line_text FROM ti",
    "stanza_blocks": f"""WITH {SRC} SELECT poem_id, stanza_index, count(*) AS line_count,
        string_agg({stripped('line_text')}, chr(10) ORDER BY line_number) AS stanza_text FROM li GROUP BY poem_id, stanza_index""",
    "raw_stanza_parts": f"""WITH a AS (SELECT poem_id, list_filter(list_transform(string_split(original_poem, chr(10) || chr(10)),
        lambda x: {stripped('x')}), lambda x: x <> '') AS parts FROM source_records WHERE original_poem IS NOT NULL)
        SELECT poem_id, generate_subscripts(parts, 1) - 1 AS part_index, unnest(parts) AS part_text FROM a""",
    "title_line_dropped": f"""WITH a AS (SELECT poem_id, poem_title, string_split(regexp_replace(original_poem, '\\r\\n?', chr(10), 'g'), chr(10)) AS ls FROM source_records),
        b AS (SELECT *, list_min(list_filter(generate_series(1, len(ls)), lambda i: NOT regexp_full_match(ls[i], '{WS}*'))) AS f FROM a)
        SELECT poem_id, CASE WHEN {key('ls[f]')} = {key('poem_title')}
        THEN array_to_string(list_filter(list_transform(generate_series(1, len(ls)), lambda i: CASE WHEN i = f THEN NULL ELSE ls[i] END), lambda x: x IS NOT NULL), chr(10))
        ELSE array_to_string(ls, chr(10)) END AS body FROM b""",
    "prompt_lines": f"""WITH {SRC}, {TGT},
        a AS (SELECT poem_id, string_agg('L' || line_number || ': ' || line_text, chr(10) ORDER BY line_number) AS x FROM li GROUP BY poem_id),
        b AS (SELECT poem_id, string_agg('T' || line_number || ': ' || line_text, chr(10) ORDER BY line_number) AS x FROM ti GROUP BY poem_id)
        SELECT p.poem_id, coalesce(a.x, '(no lines)') AS source_lines, coalesce(b.x, '(no lines)') AS target_lines
        FROM source_records p LEFT JOIN a USING (poem_id) LEFT JOIN b USING (poem_id)""",
    "prompt_stanzas": f"""WITH {SRC}, a AS (SELECT poem_id, stanza_index, string_agg({stripped('line_text')}, chr(10) ORDER BY line_number) AS x FROM li GROUP BY ALL),
        b AS (SELECT poem_id, string_agg('[STANZA ' || stanza_index || ']' || chr(10) || x, chr(10) || chr(10) ORDER BY stanza_index) AS x FROM a GROUP BY poem_id)
        SELECT p.poem_id, coalesce(b.x, '(no stanzas)') AS blocks FROM source_records p LEFT JOIN b USING (poem_id)""",
    "alignment_status": f"WITH {SRC}, {TGT}, {SIZES} SELECT poem_id, n_source, n_target, count_score, length_score, confidence, status FROM ag",
    "alignment_summary": f"""WITH {SRC}, {TGT}, {SIZES} SELECT lower({stripped('language')}) AS language, status, count(*) AS n,
        round(avg(confidence), 4) AS mean_confidence FROM ag JOIN source_records USING (poem_id) GROUP BY ALL""",
    "line_statistics": f"""WITH {SRC} SELECT poem_id, max(line_number) AS n_lines, max(stanza_index) AS n_stanzas, sum(length(line_text)) AS n_chars,
        sum(CASE WHEN {stripped('line_text')} <> line_text THEN 1 ELSE 0 END) AS n_outer_space FROM li GROUP BY poem_id""",
}
