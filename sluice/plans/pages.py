"""Pages, names, hashes, vectors and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markup, notation
from ..functions import text as T
from ..operators import relational as R
from ..streaming import latest as S
from .common import table


def page_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.posexplode(T.links(F.col("html"))).alias("i", "link")).select("page_id", F.col("i").cast("long").alias("i"), "link")


def page_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


def url_params(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", F.parse_url(u, F.lit("HOST")).alias("host"), F.try_parse_url(u, F.lit("QUERY"), F.lit("page")).alias("page"), F.try_parse_url(u, F.lit("QUERY"), F.lit("ref")).alias("ref"))


def link_roles(spark, d):
    """Links of each page merged per first letter, role flags set."""
    l = page_links(spark, d).withColumn("letter", F.lower(F.substring("link", 2, 1)))
    return l.groupBy("page_id", "letter").agg(F.count(F.lit(1)).alias("n"), F.max(F.endswith("link", F.lit(","))).alias("has_comma"), F.max(F.endswith("link", F.lit("."))).alias("has_stop"))


def bracket_balance(spark, d):
    return table(spark, d, "documents").select("doc_id", T.bracket_balance(F.col("text")).alias("round"), T.bracket_balance(F.col("text"), "[", "]").alias("square"))


def name_normalise(spark, d):
    return table(spark, d, "part").select("p_partkey", T.normal_name(F.col("p_name")).alias("name"), T.status_family(F.concat_ws(":", "p_type", "p_brand")).alias("family"))


def sha256_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


def answer_values(spark, d):
    """Answer letters of each document's whole text, and accepted answers of a made-up field."""
    made = F.concat_ws("|", F.substring("lang", 1, 1), F.lit(" "), F.substring("source", 4, 2))
    return table(spark, d, "documents").select("doc_id", F.array_join(T.answer_letters(F.col("text")), "").alias("letters"), F.array_join(T.accepted_answers(made), ",").alias("accepted"), T.question_number(F.col("source")).cast("long").alias("number"))


def answer_letters_text(spark, d):
    """Answer letters of each document's whole text, in order of their first place."""
    return table(spark, d, "documents").select("doc_id", F.array_join(T.answer_letters(F.col("text")), "").alias("letters"))


def vector_top_k(spark, d):
    e = table(spark, d, "embeddings")
    probe = F.transform("embedding", lambda _, i: ((i * 7) % 11 - 5) / F.lit(10.0))  # made up, as wide as the vectors
    return R.top_k_l2(e, "embedding", probe, 10, "vec_id").select("vec_id", F.round("distance", 6).alias("distance"))


def science_markup(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", markup.science(F.col("text")).alias("text"))


def science_notation(spark, d):
    """All steps of science and blood groups over whole texts."""
    return table(spark, d, "documents").select("doc_id", notation.science_notation(F.col("text")).alias("text"))


def question_blocks(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.inline(T.question_blocks(F.concat(F.lit("1. "), F.replace("text", F.lit("\n"), F.lit("\n2. "))))))
    return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.max("number").alias("top"))


def option_parse(spark, d):
    """Options of a block with each whole text under A, and of the markers within it."""
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("stem\n(A) "), F.col("text"), F.lit("\n(B) w\n(C) x\n(D) y")).alias("block"))
    return docs.select("doc_id", F.size(T.option_texts(F.col("block"))).cast("long").alias("n_options"), T.option_texts(F.col("block"))[0]["text"].alias("first"))


def stream_latest(spark, d):
    return S.replayed(spark, S.latest_actions(S.event_stream(spark, d)), "complete")


def stream_tumbling(spark, d):
    return S.replayed(spark, S.tumbling(S.event_stream(spark, d)), "complete")


def stream_session(spark, d):
    return S.replayed(spark, S.sessions(S.event_stream(spark, d)), "complete")


QUERIES = {
    "page_links": (page_links, """SELECT page_id, i::BIGINT - 1 AS i, l[i] AS link FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages), unnest(range(1, len(l) + 1)) AS u(i)"""),
    "page_text": (page_text, r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS text FROM pages"),
    "url_params": (url_params, """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages"""),
    "link_roles": (link_roles, """SELECT page_id, lower(substr(link, 2, 1)) AS letter, count(*) AS n, bool_or(suffix(link, ',')) AS has_comma, bool_or(suffix(link, '.')) AS has_stop FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY ALL"""),
    "bracket_balance": (bracket_balance, "SELECT doc_id, length(replace(text, ')', '')) - length(replace(text, '(', '')) AS round, length(replace(text, ']', '')) - length(replace(text, '[', '')) AS square FROM documents"),
    "name_normalise": (name_normalise, "SELECT p_partkey, regexp_replace(coalesce(p_name, ''), '[ \t\n\r\f　]+', '', 'g') AS name, split_part(p_type, ':', 1) AS family FROM part"),
    "sha256_text": (sha256_text, "SELECT doc_id, sha256(text) AS sha256 FROM documents"),
    "answer_values": (answer_values, """SELECT doc_id, array_to_string(list_distinct_ordered, '') AS letters, left(lang, 1) || CASE WHEN trim(substr(source, 4, 2)) = '' THEN '' ELSE ',' || substr(source, 4, 2) END AS accepted, try_cast(regexp_extract(source, '[0-9]{1,3}') AS BIGINT) AS number
      FROM (SELECT *, list_filter(['A', 'B', 'C', 'D'], lambda c: contains(l, c)) AS x, list_sort(list_filter(['A', 'B', 'C', 'D'], lambda c: contains(l, c)), 'ASC') AS y,
        list_transform(list_sort(list_transform(list_filter(['A', 'B', 'C', 'D'], lambda c: contains(l, c)), lambda c: lpad(instr(l, c)::VARCHAR, 12, '0') || c)), lambda c: right(c, 1)) AS list_distinct_ordered
        FROM (SELECT *, upper(coalesce(text, '')) AS l FROM documents))"""),
    "answer_letters_text": (answer_letters_text, """SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_filter(['A', 'B', 'C', 'D'], lambda c: contains(l, c)), lambda c: lpad(instr(l, c)::VARCHAR, 12, '0') || c)), lambda c: right(c, 1)), '') AS letters
      FROM (SELECT doc_id, upper(coalesce(text, '')) AS l FROM documents)"""),
    "vector_top_k": (vector_top_k, """SELECT vec_id, round(sqrt(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: pow(embedding[i]::DOUBLE - ((((i - 1) * 7) % 11 - 5) / 10.0)::DOUBLE, 2)))), 6) AS distance FROM embeddings ORDER BY distance, vec_id LIMIT 10"""),
    "science_markup": (science_markup, None),
    "science_notation": (science_notation, None),
    "question_blocks": (question_blocks, "SELECT doc_id, len(string_split(text, chr(10))) AS n_blocks, CASE WHEN contains(text, chr(10)) THEN 2 ELSE 1 END AS top FROM documents"),
    "option_parse": (option_parse, r"""WITH b AS (SELECT doc_id, regexp_replace('stem' || chr(10) || '(A) ' || text || chr(10) || '(B) w' || chr(10) || '(C) x' || chr(10) || '(D) y', '(?m)(?:^|\s)\(?([A-E])[).．、]\s*', chr(1) || '\1' || chr(2), 'g') AS m FROM documents),
      o AS (SELECT doc_id, list_transform(string_split(m, chr(1))[2:], lambda p: {'key': p[1], 'text': regexp_replace(p[3:], '^[\s　]+|[\s　]+$', '', 'g')}) AS o FROM b)
      SELECT doc_id, len(o) AS n_options, list_sort(o)[1].text AS first FROM o"""),
    "stream_latest": (stream_latest, "SELECT user_id, arg_max(event_type, (ts, event_id)) AS action FROM events GROUP BY 1"),
    "stream_tumbling": (stream_tumbling, "SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL"),
    "stream_session": (stream_session, """SELECT min(ts) AS start, user_id, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part
      FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 minutes THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, part"""),
}
