"""The operators against brute force on small tables with nulls, empty and repeated texts and clashing columns."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadmetrics.llm import chat_format, decontaminate, exact_dedup, line_dedup, mixing, near_dedup, quality, suffix_tree_lm, toxicity, url_filter
from roadmetrics.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, check

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, key string"
WORDS = [a + b for a in "ba ce di fo gu ha je ki".split() for b in "lan mer nos pit rak sul tov wex zan".split()]


def prose(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return [r.choice(WORDS) for _ in range(n)]


def docs(spark, texts, first=0):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(first + i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en", f"s{i % 3}", 0, "n", "k") for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " ", "\n\n", "x", "Éa x" * 3, (None, "no id"), (None, None), (3, "x")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    check(spark, QUERIES[name], ORACLE_SQL[name])


def test_exact_dedup(spark):
    texts = [*ODD, "Copy A", "copy a", "COPY A", "other"]
    rows = docs(spark, texts, 10)
    groups = {r.text_sha256: (r.keep_id, r.group_size) for r in exact_dedup.duplicate_groups(rows).collect()}
    want: dict = {}
    for r in rows.collect():
        want.setdefault("".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""), []).append(r.doc_id)
    assert sorted(groups.values(), key=str) == sorted(((max((i for i in v if i is not None), default=None), len(v)) for v in want.values()), key=str)
    kept = exact_dedup.exact_dedup(rows)
    assert kept.columns == rows.columns and {r.text for r in kept.collect()} >= {"COPY A", "other"}


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def edits(a, b, most=10**9):
    """The edit distance of two lists by the usual table; above most, some number above it."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for n, x in enumerate(a, 1):
        before, row[0] = row[0], n
        for m in range(1, len(row)):
            before, row[m] = row[m], min(before + (x != b[m - 1]), row[m] + 1, row[m - 1] + 1)
        if min(row) > most:
            return most + 1
    return row[-1]


@pytest.mark.parametrize("edit", [1.0, 0.9])
def test_near_dedup_against_brute_force(spark, edit):
    texts = []
    for k in range(25):
        base = prose(k, 120 + k)
        texts.append(base)
        changed = list(base)
        for at in ([10], [10, 11], [60, 64], [3, 20, 40, 60, 80, 100], range(0, len(base), 8))[k % 5]:
            changed[at] = "changed"
        texts.append(changed)
    rows = docs(spark, [*(" ".join(t) for t in texts), *["a b c d e f g h"] * 4])
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(rows, edit=edit).collect()}
    everything = [*texts, *["a b c d e f g h".split()] * 4]
    root = list(range(len(everything)))
    for i, a in enumerate(everything):
        for j in range(i):
            x, y = shingles(a), shingles(everything[j])
            both = sum((x & y).values())
            most = max(len(a), len(everything[j])) * (1 - edit) + 1e-9
            if both >= 0.8 * (sum(x.values()) + sum(y.values()) - both) or (most >= 1 and edits(a, everything[j], most) <= most):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert got == dict(enumerate(root))
    stay = near_dedup.near_dedup(rows, edit=edit)
    assert stay.columns == rows.columns and stay.count() == len(set(root))


@pytest.mark.parametrize("dedup", [exact_dedup.exact_dedup, near_dedup.near_dedup])
def test_one_row_of_each_text_stays_whatever_its_id(spark, dedup):
    a, b, c, d, e = (" ".join(prose(500 + i, 60)) for i in range(5))
    rows = docs(spark, [(None, a), (None, b), (None, a), (7, c), (7, d), (7, c), (6, c), (8, c), (9, e), (9, e), (None, None), (None, "")])
    got = dedup(rows).collect()
    assert sorted(r.text or "" for r in got) == sorted([a, b, c, d, e, ""])
    assert sorted(str(r.doc_id) for r in got if r.text in (a, b, d, e)) == ["7", "9", "None", "None"]


def test_line_dedup(spark):
    passage = [" ".join(prose(1000 + i, 12)) for i in range(6)]
    unique = lambda s: [" ".join(prose(s * 10 + i, 9)) for i in range(8)]
    texts = ["\n".join(unique(1) + passage), "\n".join(unique(2) + passage + unique(3)), "\n".join(passage[:3]), "\n".join(unique(4))]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs(spark, texts), counts=True).collect()}
    assert out[0].text == texts[0] and out[3].text == texts[3]
    assert out[1].text == "\n".join(unique(2) + unique(3)) and out[1].n_removed == 6
    assert out[2].text == texts[2]  # 36 words are no run
    odd = docs(spark, ODD)
    assert sorted((str(r.doc_id), str(r.text)) for r in line_dedup.dedup_lines(odd).collect()) == sorted((str(r.doc_id), str(r.text)) for r in odd.collect())


def test_line_dedup_against_all_repeated_windows(spark):
    """Three parts of 30 words, of which each two documents share two; which of the shingles is least differs by k."""
    part = lambda k, i: [" ".join(prose(7000 + 100 * k + 10 * i + j, 10)) for j in range(3)]
    texts = [x for k in range(12) for one, two, three in [[part(k, i) for i in range(3)]] for x in (one + two, two + three, one + two + three)]
    seen, want = set(), []
    for lines in texts:
        cut, own = set(), []
        for i in range(len(lines)):
            ends = [j for j in range(i, len(lines)) if sum(len(x.split()) for x in lines[i : j + 1]) >= 50]
            if ends:
                own.append(tuple(lines[i : ends[0] + 1]))
                if own[-1] in seen:
                    cut |= set(range(i, ends[0] + 1))
        seen |= set(own)
        want.append("\n".join(x for i, x in enumerate(lines) if i not in cut))
    got = sorted(line_dedup.dedup_lines(docs(spark, ["\n".join(x) for x in texts])).collect(), key=lambda r: r.doc_id)
    assert [r.text for r in got] == want and want[2::3] == [""] * 12


def test_decontamination_blocks_agree(spark):
    item = prose(7, 30)
    texts = [" ".join(prose(8, 20) + item[4:20] + prose(9, 20)), " ".join(prose(10, 50)), "short One", " ".join(prose(11, 2000) + item[:13]), *ODD]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "short one"), (3, None), (4, ""), (None, "x"), (1, " ".join(item))], "item_id bigint, text string")
    got = decontaminate.contamination(docs(spark, texts), bench).collect()
    by_id = {r.doc_id: r for r in reversed(sorted(got, key=lambda r: r.n_words)) if r.doc_id is not None}
    by_id |= {3: max((r for r in got if r.doc_id == 3), key=lambda r: r.n_words)}
    assert len(got) == len(texts)
    assert (by_id[0].n_hit, by_id[0].n_items, by_id[0].contaminated, by_id[0].longest_words) == (16, 1, True, 16)
    assert (by_id[1].n_hit, by_id[2].n_hit, by_id[2].contaminated) == (0, 2, True)
    assert (by_id[3].n_hit, by_id[3].contaminated) == (13, False)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    small = decontaminate.contamination(docs(spark, texts), bench, block_words=5).select(columns).collect()
    assert sorted(map(str, small)) == sorted(str(r) for r in decontaminate.contamination(docs(spark, texts), bench).select(columns).collect())
    assert decontaminate.remove_contaminated(docs(spark, texts), bench).filter("doc_id IN (0, 2)").count() == 0


def test_mixing_meets_targets(spark):
    rows = docs(spark, [" ".join(prose(i, 5 + i % 40)) for i in range(600)])
    out = mixing.mix_sources(rows)
    for r in out.groupBy("target", "source_size").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most")).collect():
        assert abs(r.taken - r.target) <= 45 and r.most <= 3
    assert mixing.mix_sources(docs(spark, ODD)).count() == len(ODD)


def test_suffix_tree_base_and_gain(spark):
    chain = [" ".join((["alpha", "beta", "gamma", "delta"] * 40)[i % 4 : 100 + i % 7]) for i in range(60)]
    texts = [*chain, "unseen words", *ODD]
    rows = docs(spark, texts).collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in r.text or "")), None] for r in rows]
    counts = Counter(t for r, ts in zip(rows, tokens) if not held(r.doc_id) for t in ts)
    n = sum(counts.values())
    want = sorted((len(ts), sum(counts[t] > 0 for t in ts), n, round(sum(math.log10((counts[t] + 1) / (n + len(counts) + 1)) for t in ts), 6)) for ts in tokens)
    got = suffix_tree_lm.score_documents(docs(spark, texts), divergence=1.0).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    long = [r for r in got if r.n_tokens > 50 and r.held_out]
    assert long and all(r.score > 0.5 * r.base_score for r in long)


def tree_by_brute_force(texts, held, divergence, test=0.7):
    """Scores by dictionaries over the pooled counts of all training texts."""
    rows = [[None, *t.split(), None] for t in texts]
    ends = lambda ts, i: [tuple(ts[i - d : i]) for d in (1, 2, 3) if d <= i]
    words, pairs, succ = Counter(), Counter(), {}
    for r, ts in enumerate(rows):
        for i in range(1, len(ts)):
            if not held(r):
                words[ts[i]] += 1
                for c in ends(ts, i):
                    pairs[c, ts[i]] += 1
                    succ.setdefault(c, set()).add(ts[i])
    total, size = sum(words.values()), Counter()
    for (c, _), n in pairs.items():
        size[c] += n
    gain, seen = Counter(), list(words.values())
    once, twice = seen.count(1), seen.count(2)
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    for r, ts in enumerate(rows):
        for i in range(1, len(ts)):
            if not held(r):
                p = (max(words[ts[i]] - 1 - test, 0) + test * len(words) / total) / (total - 1)
                for c in ends(ts, i):
                    if size[c] > 1:
                        own = (max(pairs[c, ts[i]] - 1 - test, 0) + test * len(succ[c]) * p) / (size[c] - 1)
                        gain[c] += math.log(own / p)
                        p = own
    out = []
    for ts in rows:
        out.append(0.0)
        for i in range(1, len(ts)):
            p = (words[ts[i]] - discount) / total if words[ts[i]] else discount * len(words) / total
            for c in ends(ts, i):
                if size[c] > 1 and gain[c] >= divergence:
                    p = (max(pairs[c, ts[i]] - discount, 0) + discount * len(succ[c]) * p) / size[c]
            out[-1] += math.log10(p)
    return out


@pytest.mark.parametrize("divergence,heavy,parts", [(20.0, 1 << 20, 90), (3.0, 1 << 20, 7), (3.0, 60, 90), (6.0, 5, 3), (suffix_tree_lm.DIVERGENCE, 60, 7)])
def test_suffix_tree_against_brute_force(spark, monkeypatch, divergence, heavy, parts):
    """Down to one document a partition, so that contexts are frequent in all but rare, or without gain, in each block;
    with no, some and nearly all words heavy."""
    monkeypatch.setattr(suffix_tree_lm, "HEAVY_FROM", heavy)
    r = random.Random(5)
    texts = [" ".join(w for _ in range(4) for w in (*r.choice((("lot", "of", "salt"), ("pot", "of", "soup"))), *r.sample(WORDS, 3))) for _ in range(90)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = tree_by_brute_force(texts, held, divergence)
    got = suffix_tree_lm.score_documents(docs(spark, texts).repartition(parts, "doc_id"), divergence=divergence).collect()
    assert [round(x.score, 3) for x in sorted(got, key=lambda x: x.doc_id)] == [round(x, 3) for x in want]


@pytest.mark.parametrize("score,label,least", [(quality.score_quality, "quality", 0.8), (toxicity.score_toxicity, "toxic", 0.8)])
def test_held_out_accuracy(spark, score, label, least):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    out = score(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out")
    right = out.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= least
    odd = score(docs(spark, ODD), read("labels")).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)


def test_chat_round_trip_and_rewriting(spark):
    texts = [None, "", "</s>[INST] ok [/INST]", "\\", "[\\INST] \\[INST]", "[ROLE=x] ␟ ␟", "plain"]
    rows = [(1, i, role, t) for i, t in enumerate(texts) for role in ("user", "assistant", "tool]\\", None)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    segments = chat_format.format_conversations(table).orderBy("turn_no").collect()
    whole = "".join(r.segment for r in segments)
    want = sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or ""))
    assert list(chat_format.read_turns(whole)) == [(r or "", t or "") for _, _, r, t in want]
    for r, (_, _, _, text) in zip(segments, want):
        assert chat_format.unescape(r.segment[r.text_start : r.text_end]) == (text or "")
    last_only = lambda turns: f"{len(turns)}:{turns[-1][1]}"
    assert chat_format.format_conversations(table, last_only).filter("rewrites_history").count() > 0


def test_url_rules_and_segmentation(spark):
    urls = [None, "", "no scheme", "http://A.Example.org/es/1?x", "https://example.org/en/12#f", "http://x.com/de/a", "http://x.com/fr/", "http://notexample.org/es/", "ftp://casinobonus.net/poker/slots"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert out[0] == out[1] == out[2] == ("", "", None, "allow")
    assert out[3] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert out[4][2:] == ("example.org/en/1", "block") and out[5][2:] == ("com/de/", "block") and out[6][2:] == ("com/fr/", "allow")
    assert out[7][2:] == ("org/", "allow") and out[8][2:] == (None, "block")
    assert url_filter.viterbi("gardenschool", [(0, 6, 9), (6, 6, 9)], 100, 32) == ["garden", "school"]


def test_url_on_many_pages_is_judged_as_on_one(spark):
    judge = lambda urls: {(r.verdict, r.host_words) for r in url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")).filter("host LIKE '%casinobonus%'").collect()}
    others = [f"http://site{w}.net/{w}/{v}" for w, v in zip(WORDS, WORDS[1:])]
    spam = ["http://casinobonus.net/casinobonus", "http://www.casinobonus.net/", "http://a.casinobonus.info/x"]
    assert judge(spam[:1]) == judge(spam[:1] * 2) == judge(spam[:1] * 500 + others) == {("block", "casino bonus")}
    assert judge(spam * 50 + others) == {("block", "casino bonus")}


def test_empty_tables(spark):
    none = docs(spark, ODD).limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    pages = spark.createDataFrame([], "page_id bigint, url string")
    talks = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    made = [
        exact_dedup.duplicate_groups(none), near_dedup.near_classes(none), line_dedup.dedup_lines(none), decontaminate.contamination(none, bench), mixing.mix_sources(none), suffix_tree_lm.score_documents(none),
        quality.score_quality(none, labels), toxicity.score_toxicity(none, labels), url_filter.judge_urls(pages), chat_format.read_back(chat_format.format_conversations(talks)),
    ]
    assert [m.count() for m in made] == [0] * len(made)


def test_odd_rows_stay_through_every_operator(spark):
    odd = docs(spark, ODD)
    bench = spark.createDataFrame([(1, "item")], "item_id bigint, text string")
    assert near_dedup.near_classes(odd).count() == len(ODD)
    assert decontaminate.remove_contaminated(odd, bench).count() == len(ODD)
    assert near_dedup.near_dedup(odd).columns == odd.columns


def test_pipeline_stages(spark):
    import corpus_pipeline

    rows, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.common.materialize(stage(spark, rows, SF), "test-stage")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == rows.columns
        before, rows = rows.count(), out
        assert rows.count() <= before
    assert set(rows.columns) >= {"doc_id", "size", "target", "taken"}


def test_mixing_of_rows_without_ids(spark):
    """Rows of one source that share an id, or have none, are told apart by their texts."""
    rows = docs(spark, [(None, " ".join(prose(i, 20))) for i in range(400)]).withColumn("source", F.when(F.rand(3) < 0.8, F.lit("b")))
    for r in mixing.mix_sources(rows).groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= 20


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from roadmetrics.llm import common

    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(SimpleNamespace(sparkContext=context))


def test_mixing_of_repeated_rows(spark, tmp_path):
    """300 rows without an id and with one text are units of their own: the source comes near its target."""
    from tests.oracle import connect, rows_of

    rows = spark.createDataFrame([(None, "one two three", "a")] * 300 + [(i, f"w{i} x y", "b") for i in range(300)] + [(7, "w7 x y", "b")] * 40 + [(7, "w7 x y", None)] * 3, "doc_id bigint, text string, source string").repartition(5)
    got = mixing.mix_sources(rows)
    for r in got.groupBy("target", "source_size").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= 3
    rows.write.parquet(f"{tmp_path}/documents")
    con = connect()
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    assert rows_of(got.toPandas()) == rows_of(con.execute(ORACLE_SQL["op5_mix_sources"]).df())
