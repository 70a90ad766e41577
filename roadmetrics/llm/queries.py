"""The operators' queries over the test tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, exact_dedup, line_dedup, mixing, near_dedup, ngram_jaccard, quality, resampling, spelling, suffix_tree_lm, toxicity, url_filter

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op3_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score_documents(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.format_conversations(conversations, whole=True))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_classes(_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_suffix_tree_lm": op3_suffix_tree_lm,
    "op4_quality": op4_quality,
    "op5_mix_sources": op5_mix_sources,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_format_chat": op9_format_chat,
    "op10_url_filter": op10_url_filter,
    "op11_resample": op11_resample,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_spelling": op13_spelling,
}

#: CRC-32 of the rows of a table `strings` (column x) as a table `crc` (x, c): the byte table by the polynomial's rule, then byte by byte.
CRC = """
        bit(i, k, v) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
                         SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bit WHERE k < 8),
        byte AS (SELECT i, v FROM bit WHERE k = 8),
        state(x, hx, p, c) AS (SELECT x, hex(encode(x)), 0, CAST(4294967295 AS BIGINT) FROM strings UNION ALL
                               SELECT x, hx, p + 1, xor(c >> 8, v) FROM state JOIN byte ON i = xor(c, CAST('0x' || substr(hx, 2 * p + 1, 2) AS BIGINT)) & 255
                               WHERE 2 * p < length(hx)),
        crc AS (SELECT x, xor(c, 4294967295) AS c FROM state WHERE 2 * p = length(hx))"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {LOWER} AS content FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(content) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY content)""",
    "op5_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, size, CASE WHEN k = 1 THEN h0 ELSE CAST(('0x' || substr(md5(h0 || chr(10) || (k - 1)), 1, 15)) AS BIGINT) END AS h FROM (
                SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                       row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) AS k,
                       CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 15)) AS BIGINT) AS h0
                FROM documents)),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
        c AS (SELECT *, source_size * 3 AS cap FROM w),
        u AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                     / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS unit
              FROM c WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST)),
        f AS (SELECT *, first(CASE WHEN unit * weight <= cap THEN unit END IGNORE NULLS) OVER
                     (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS free_unit FROM u),
        t AS (SELECT source, source_size, coalesce(free_unit * weight, CAST(cap AS DOUBLE)) AS target FROM f),
        p AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS whole FROM t),
        g AS (SELECT d.source, d.h, sum(d.size) AS words FROM d GROUP BY d.source, d.h),
        m AS (SELECT source, h, sum(words) OVER (PARTITION BY source ORDER BY h) - words / 2.0 AS middle FROM g)
        SELECT d.doc_id, d.size, p.source_size, p.target,
               CAST(d.size * (p.whole + CASE WHEN m.middle <= p.target - p.whole * p.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken,
               CAST(p.whole + CASE WHEN m.middle <= p.target - p.whole * p.source_size THEN 1 ELSE 0 END AS BIGINT) AS epochs
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
               JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.h = m.h""",
    "op7_decontaminate": r"""
        WITH RECURSIVE dw AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(__LOWER__, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(__LOWER__, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS k, least(len(w), 13) AS n
                FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM bw WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM win),
        pos AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
                FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n)),
        hit AS (SELECT pos.r, pos.i, pos.n, win.item FROM pos JOIN win ON pos.k = win.k AND pos.n = win.n),
        words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r),
        its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN words USING (r) LEFT JOIN its USING (r)""".replace("__LOWER__", LOWER),
    "op9_format_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        r AS (
            SELECT conv_id, turn, text AS sort_text, coalesce(role, '') AS role, role AS sort_role, coalesce(text, '') AS text,
                   replace(replace(replace(replace(replace(replace(replace(replace(replace(coalesce(text, ''), '\', '\\'),
                     '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '[SYS]', '[\SYS]'), '[/SYS]', '[\/SYS]'),
                     '[ROLE=', '[\ROLE='), '[/ROLE]', '[\/ROLE]') AS shown
            FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, sort_role NULLS FIRST, sort_text NULLS FIRST)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, sort_text NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(3 + sum(length(shown) + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 4 ELSE 17 + length(role) END) AS BIGINT) AS formatted_chars
        FROM r GROUP BY conv_id""",
    "op11_resample": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(__LOWER__, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        dw AS (SELECT r, unnest(w) AS x FROM d),
        bw AS (SELECT unnest(regexp_extract_all(__LOWER__, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
        strings AS (SELECT x FROM dw UNION SELECT x FROM bw),__CRC__,
        n AS (SELECT r, x, count(*) AS n FROM dw GROUP BY r, x),
        s AS (SELECT c % 10000 AS b, sum(n) AS s FROM n JOIN crc USING (x) GROUP BY 1),
        t AS (SELECT c % 10000 AS b, count(*) AS t FROM bw JOIN crc USING (x) GROUP BY 1),
        gain AS (SELECT b, CAST(floor(CAST(1000 AS DOUBLE) * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST((SELECT count(*) FROM dw) AS DOUBLE) + 10000)
                                        / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST((SELECT count(*) FROM bw) AS DOUBLE) + 10000)))) AS BIGINT) AS gain
                 FROM s FULL JOIN t USING (b)),
        weights AS (SELECT r, CAST(sum(n * gain) AS BIGINT) AS weight FROM n JOIN crc USING (x) JOIN gain ON b = c % 10000 GROUP BY r),
        scored AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + CAST(floor(CAST(-1000 AS DOUBLE) * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
                   FROM d LEFT JOIN weights USING (r)),
        ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (r)""".replace("__LOWER__", LOWER).replace("__CRC__", CRC),
    "op12_ngram_jaccard": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(__LOWER__, '[^\x20\x09-\x0D]+') AS w FROM documents),
        sh AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS k, least(len(w), 4) AS words
               FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
        size AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
        overlap AS (SELECT a.r AS r1, b.r AS r2, count(*) AS o FROM sh a JOIN sh b ON a.k = b.k AND a.words = b.words AND a.r < b.r GROUP BY 1, 2),
        link AS (SELECT r1, r2 FROM overlap JOIN size x ON x.r = r1 JOIN size y ON y.r = r2 WHERE 100 * o >= 85 * (x.n + y.n - o)),
        edge AS (SELECT r1 AS u, r2 AS v FROM link UNION ALL SELECT r2, r1 FROM link),
        reach(r, other) AS (SELECT r, r FROM d UNION SELECT reach.r, edge.v FROM reach JOIN edge ON edge.u = reach.other)
        SELECT x.doc_id, coalesce(size.n, 0) AS n_shingles, min(y.doc_id) AS component_id
        FROM reach JOIN d x ON x.r = reach.r JOIN d y ON y.r = reach.other LEFT JOIN size ON size.r = x.r
        GROUP BY x.r, x.doc_id, size.n""".replace("__LOWER__", LOWER),
    "op13_spelling": r"""
        WITH RECURSIVE t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(__LOWER__, '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
        counted AS (SELECT id, run, count(*) AS n, id || ':' || run AS x FROM t WHERE length(run) >= 7 GROUP BY id, run),
        strings AS (SELECT DISTINCT x FROM counted),__CRC__,
        slipped AS (SELECT CASE WHEN c % 31 = 0 THEN substr(run, 1, CAST(c % length(run) AS BIGINT)) || substr(run, CAST(c % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM counted JOIN crc USING (x)),
        w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        p AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM w)),
        near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM p a JOIN p b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
                 UNION SELECT a.word, b.word, b.n FROM p a JOIN w b ON a.head || a.tail = b.word
                 UNION SELECT b.word, a.word, a.n FROM p a JOIN w b ON a.head || a.tail = b.word),
        best AS (SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, hex(encode(near))) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
        f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
              FROM w LEFT JOIN best ON best.word = w.word AND k = 1),
        chain(word, root) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM f JOIN chain ON chain.word = f.word
        JOIN f e ON e.word = chain.root AND e.form IS NULL""".replace("__LOWER__", LOWER).replace("__CRC__", CRC),
}
