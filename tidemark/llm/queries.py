"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .chat_format import format_chats, log_of, read_back
from .collocations import collocations
from .common import read
from .decontaminate import contained
from .exact_dedup import exact_dedup
from .language_id import dictionaries, held_out, identify
from .mixing import mix
from .near_dedup import near_dedup
from .quality import quality
from .spelling import variants
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity
from .url_filter import url_filter

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    test = held_out(2, 4)
    found = identify(docs.select("doc_id", "text"), dictionaries(docs.where(~test)))
    return found.select("doc_id", test.alias("held_out"), "lang_pred", "score", "lang_margin", "lang_rejected")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(read(spark, sf_dir, "pages"), rules)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\\### Assistant: </turn> ok"
    odd = spark.sql(f"select -7L as conv_id, turn, role, '{said}' as text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)")
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return read_back(format_chats(log_of(conversations)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = held_out(1, 3)
    labels = read(spark, sf_dir, "labels").where(~test).select("doc_id", F.col("quality").alias("label"))
    return quality(read(spark, sf_dir, "documents").select("doc_id", "text"), labels).select("doc_id", test.alias("held_out"), "score", "predicted")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).drop("raw_sha256")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read(spark, sf_dir, "documents"), with_kept_text=False).drop("kept_text")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents"), with_kept_bytes=False).drop("kept_bytes")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = held_out(0, 5)
    labels = read(spark, sf_dir, "labels").where(~test).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity(read(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return found.select("doc_id", test.alias("held_out"), "score", "predicted", "n_hits")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_decontaminate": op1_decontaminate,
    "op2_language_id": op2_language_id,
    "op3_url_filter": op3_url_filter,
    "op4_mixing": op4_mixing,
    "op5_chat_format": op5_chat_format,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_near_dedup": op10_near_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_collocations": op12_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op1_decontaminate": r"""
        WITH t AS (
            SELECT true AS is_item, item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws FROM benchmark
            UNION ALL SELECT false, doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') FROM documents),
        sizes AS (SELECT DISTINCT least(5, len(ws)) AS size FROM t WHERE is_item AND len(ws) > 0 UNION SELECT 5),
        s AS (
            SELECT DISTINCT is_item, id, array_to_string(ws[i:i + size - 1], ' ') AS shingle
            FROM (SELECT is_item, id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM t JOIN sizes ON NOT is_item OR size = least(5, len(ws)))),
        q AS (SELECT id AS item_id, count(*) AS item_shingles FROM s WHERE is_item GROUP BY 1),
        h AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS hits FROM s b JOIN s d ON b.shingle = d.shingle AND b.is_item AND NOT d.is_item GROUP BY 1, 2)
        SELECT doc_id, item_id, item_shingles, hits, hits / item_shingles AS containment FROM h JOIN q USING (item_id) WHERE hits >= ceil(0.8 * item_shingles - 1e-9)""",
    "op8_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS window_text FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
        f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY window_text) AS first_doc FROM k),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM f WHERE first_doc < doc_id),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
        SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS joint FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE joint >= 0.8 * (x.n + y.n - joint)),
        reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        c AS (SELECT d.doc_id, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS class_id FROM documents d LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id)
        SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM c""",
    "op3_url_filter": """
        WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
        m AS (SELECT *, '.' || host AS dotted FROM p)
        SELECT page_id, host, path,
            CASE WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'net/'
                 WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ends_with(dotted, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule,
            CASE WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'allow'
                 WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'block'
                 WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'block'
                 ELSE 'allow' END AS verdict
        FROM m""",
    "op5_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        s AS (SELECT *, length(text) - length(replace(text, '\', '')) + length(array_to_string(regexp_extract_all(text, '#{3,}'), ''))
                 + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS extra FROM c)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(4 + length(role) + 2 + length(text) + extra + 8)::BIGINT AS formatted_chars
        FROM s GROUP BY conv_id""",
    "op7_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
        k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
    "op12_collocations": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents),
        lowered AS (SELECT row, lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM d),
        p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        g AS (
            SELECT lang, k AS words, ws[i:i + k - 1] AS gram
            FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w CROSS JOIN (SELECT unnest([1, 2, 3]) AS k))),
        f AS (SELECT lang, words, gram, count(*)::HUGEINT AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY 1),
        cuts AS (
            SELECT c.lang, c.words, c.gram, c.f AS a, k, l.f AS l, r.f AS r, 1000000 * c.f * c.f // (l.f * r.f) AS score
            FROM (SELECT *, unnest(range(1, words)) AS k FROM f WHERE words > 1 AND f >= 10) c
            JOIN f l ON l.lang = c.lang AND l.gram = c.gram[1:k] JOIN f r ON r.lang = c.lang AND r.gram = c.gram[k + 1:c.words]),
        scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(a) AS most FROM (SELECT lang, a, unnest([gram[1:2], gram[2:3]]) AS part FROM scored WHERE words = 3) GROUP BY ALL),
        kept AS (
            SELECT s.*, array_to_string(s.gram, ' ') AS phrase FROM scored s LEFT JOIN longer o ON s.words = 2 AND o.lang = s.lang AND o.part = s.gram
            WHERE o.most IS NULL OR 100 * o.most < 50 * s.a),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM placed JOIN n USING (lang) WHERE rank <= 2000""",
    # crc32 by the table of its polynomial; neighbours by what is left of two words without one code point
    "op13_spelling_variants": r"""
        WITH RECURSIVE crc(byte, step, c) AS (
            SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
            UNION ALL SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE step < 8),
        codes AS (SELECT list(c ORDER BY byte) AS code FROM crc WHERE step = 8),
        runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents),
        each_run AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
        hashed AS (
            SELECT run, times, xor(4294967295, list_reduce(
                list_transform(range(0, strlen(t)), lambda i: ('0x' || substr(hx, (2 * i + 1)::INT, 2))::BIGINT),
                lambda c, x: xor(c >> 8, code[xor(c & 255, x) + 1]), 4294967295::BIGINT)) AS h
            FROM (SELECT run, times, t, hex(encode(t)) AS hx FROM (SELECT *, doc_id::VARCHAR || ':' || run AS t FROM each_run)) CROSS JOIN codes),
        cut AS (
            SELECT times, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
        words AS (SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY 1 HAVING sum(times) >= 3),
        less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
        about AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM pairs GROUP BY 1),
        forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
            FROM words LEFT JOIN about USING (word)),
        up(word, top) AS (SELECT word, word FROM forms UNION ALL SELECT u.word, f.form FROM up u JOIN forms f ON f.word = u.top WHERE f.form IS NOT NULL),
        roots AS (SELECT u.word, u.top AS root FROM up u JOIN forms f ON f.word = u.top WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)""",
}
