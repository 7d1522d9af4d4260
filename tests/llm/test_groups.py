"""Duplicates, mixing, archives, pages, lines and the pipeline: against brute force and SQL."""

import gzip
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import TESTDATA
from llm.conftest import EDGES, prose
from windrisk.llm import circulant, components, digest_merge, line_templates, mixing, revisits, template
from windrisk.llm.queries import ORACLES, QUERIES
from windrisk.session import work_path

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    import sys
    from conftest import ROOT
    sys.path.insert(0, f"{ROOT}/tools")
    from check import compare
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    assert compare(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()) == ""


@pytest.mark.parametrize("smallest", [True, False])
def test_exact_groups_edges(make_docs, smallest):
    rows = EDGES + [(9, "ONE"), (8, "É"), (10, "é")]
    got = digest_merge.exact_groups(make_docs(rows), smallest=smallest, runs=8, bits=1).collect()
    assert len(got) == len(rows)
    one = [r for r in got if r.group_size == 5]
    assert len(one) == 5 and {r.keep_id for r in one} == {4 if smallest else 9} and sum(r.kept for r in one) == 1
    empty = [r for r in got if r.keep_id in (1, 2) and r.group_size == 3]
    assert len(empty) == 3 and sum(r.kept for r in empty) == 1
    assert sum(r.kept for r in got) == len({(t or "").lower() if (t or "").isascii() else t for _, t in rows})
    assert digest_merge.exact_groups(make_docs(rows).limit(0)).count() == 0


def brute_components(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    root = {i: i for i in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows():
    rng = random.Random(7)
    rows = []
    for group in range(12):
        base = prose(rng, rng.choice([8, 60, 200])).split()
        for copy in range(rng.choice([1, 2, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = "edit" + str(rng.randrange(99))
            rows.append((len(rows), " ".join(words)))
    passage = prose(rng, 60)
    rows += [(len(rows) + k, passage + " " + prose(rng, rng.choice([15, 40]))) for k in range(40)]
    return rows


def test_near_groups_equal_brute_force(make_docs):
    rows = near_rows() + [(1001, None), (1002, ""), (1003, "w"), (1004, "W "), (1005, "w " * 20_000)]
    got = {r.id: (r.n_shingles, r.component_id) for r in circulant.near_groups(make_docs(rows)).collect()}
    assert got == brute_components(rows)


def test_blocks_cuts_and_small_limits_lose_nothing(make_docs, monkeypatch):
    """Every way of comparing the tail, forced by tiny limits."""
    monkeypatch.setattr(circulant, "CLUSTER", 3)
    monkeypatch.setattr(circulant, "BLOCK", 2)
    monkeypatch.setattr(circulant, "CUTS", 1)
    rows = near_rows()
    got = {r.id: (r.n_shingles, r.component_id) for r in circulant.near_groups(make_docs(rows)).collect()}
    assert got == brute_components(rows)


def test_a_centre_that_all_its_mates_pass_over_keeps_its_links(make_docs):
    rng = random.Random(1733)  # the first document is the centre of the second one's buckets, which proposes to the third
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(200)]]
    for _ in range(2):
        words = list(texts[-1])
        for at in rng.sample(range(200), 5):
            words[at] = "edit" + str(rng.randrange(10**6))
        texts.append(words)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    got = {r.id: r.component_id for r in circulant.near_groups(make_docs(rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 0} == {i: c for i, (_, c) in brute_components(rows).items()}


def test_shingles_that_fold_together_do_not_hide_a_link():
    import numpy as np
    import pandas as pd
    import pyarrow as pa
    x = np.array([1, 2, 3 << 40, 5 << 40], dtype=np.uint64)  # the first two agree in 24 bits
    sets = pa.RecordBatch.from_arrays([pa.array([b"a", b"b"]), pa.array([x[:3].tobytes(), x.tobytes()])], names=["node", "shingles"])
    rows = next(circulant._folded(iter([sets]))).to_pandas().rename(columns={"s_node": "node"})
    got = circulant._compare(pd.DataFrame(rows).assign(component=[b"a", b"b"], part=0))
    assert list(zip(got["a"], got["b"])) == [(b"a", b"b")]


def folded_rows(sets):
    import numpy as np
    import pyarrow as pa
    nodes = pa.array([b"%06d" % i for i in range(len(sets))])
    batch = pa.RecordBatch.from_arrays([nodes, pa.array([np.unique(np.array(sorted(s), dtype=np.uint64)).tobytes() for s in sets])], names=["node", "shingles"])
    return next(circulant._folded(iter([batch]))).to_pandas().rename(columns={"s_node": "node"})


def test_sets_that_share_only_a_passage_are_not_paired_with_each_other():
    """Half of each set is common to all: 18 million pairs share it, and none of them is similar."""
    import time
    rng = random.Random(5)
    rows = folded_rows([{k << 40 for k in range(12)} | {rng.randrange(1 << 63) for _ in range(13)} for _ in range(6000)])
    began = time.process_time()
    assert not len(circulant._compare(rows.assign(component=rows["node"], part=0)))
    assert time.process_time() - began < 2


@pytest.mark.parametrize("crowd", [2, 64, 10**6])
def test_block_pairs_compared_together_equal_brute_force(monkeypatch, crowd):
    """Families of one base with edits, in several block pairs of one frame, one side or two; components known beforehand are kept apart by none."""
    import pandas as pd
    import pyarrow as pa
    monkeypatch.setattr(circulant, "CROWD", crowd)
    monkeypatch.setattr(circulant, "PAIRS", 50)
    monkeypatch.setattr(circulant, "TOGETHER", 3000)
    rng = random.Random(crowd)
    frames, want = [], set()
    for group in range(12):
        sets, n = [], rng.choice([2, 9, 90])
        base = [rng.randrange(1 << 63) for _ in range(rng.choice([8, 60]))]
        for _ in range(n):
            drop = rng.randrange(len(base) // 2)
            sets.append(set(base[drop:]) | {rng.randrange(1 << 63) for _ in range(rng.randrange(len(base) // 3))})
        sides = [rng.randrange(2) if group % 2 else 0 for _ in sets]
        rows = folded_rows(sets)
        names = [b"%03d-%06d" % (group, i) for i in range(n)]
        known = [names[i - i % 3] if group % 3 else names[i] for i in range(n)]
        frames.append(rows.assign(node=names, component=known, group=group, low=0, high=group % 2, part=sides))
        root = {i: i - i % 3 if group % 3 else i for i in range(n)}
        for i in range(n):
            for j in range(i):
                if (not group % 2 or sides[i] != sides[j]) and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                    x, y = root[i], root[j]
                    root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
        want |= {frozenset(names[k] for k in root if root[k] == r) for r in set(root.values())}
    columns = ["group", "low", "high", "part", "node", "component", "size", "folded"]
    batches = pa.Table.from_pandas(pd.concat(frames)[columns], preserve_index=False).to_batches(max_chunksize=7)
    edges = [(r["a"], r["b"]) for batch in circulant._block_pairs(iter(batches)) for r in batch.to_pylist()]
    label = {n: c for f in frames for n, c in zip(f["node"], f["component"])}
    joined = 0
    for a, b in edges:
        x, y = label[a], label[b]
        joined += x != y
        label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    assert {frozenset(k for k in label if label[k] == r) for r in set(label.values())} == want and joined


def test_a_bitmap_too_small_for_the_buckets_loses_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(circulant, "MARK_BITS", 15)
    monkeypatch.setattr(circulant, "CROWD", 2)
    monkeypatch.setattr(circulant, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(circulant, "CLUSTER_SHINGLES", 3000)
    rng = random.Random(11)
    rows = near_rows()
    rows += [(len(rows) + k, prose(rng, 40) if k % 2 else rng.choice(rows)[1] + " end" * (k % 3)) for k in range(400)]
    got = {r.id: (r.n_shingles, r.component_id) for r in circulant.near_groups(make_docs(rows)).collect()}
    assert got == brute_components(rows)


def test_shingles_of_many_texts_equal_sets_of_words():
    import numpy as np
    from windrisk.llm.shingles import shingle_set, shingle_sets
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "a", "A b", "a b\x0bc d", "a b c d E", "é x y " + "z" * 300 + " " + "w" * 256 + " " + "q" * 257 + " " + "q" * 258, "w " * 2000,
             "x\x00 x x\x00\x00 y z q", "no\x1cbreak a b c d"] + [prose(rng, n).replace("1", rng.choice(["1", "Éa", " \r\n"])) for n in range(1, 90)]
    values, counts = shingle_sets([t.encode() if t is not None else None for t in texts])
    parts = np.split(values, np.cumsum(counts)[:-1])
    every = {}
    for text, part in zip(texts, parts):
        words = (text or "").encode().lower().split()
        want = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        assert len(part) == len(want) and np.array_equal(part, np.unique(part)) and np.array_equal(part, shingle_set(text))
        for shingle in want:
            every.setdefault(shingle, len(every))
    assert len(np.unique(values)) == len(every)


def test_near_groups_edges(make_docs):
    got = circulant.near_groups(make_docs([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "q r s"), (None, None)])).collect()
    assert Counter((r.id, r.component_id, r.kept) for r in got) == Counter({(3, 3, True): 2, (None, 3, False): 1, (None, None, True): 2})
    assert circulant.near_groups(make_docs([(1, "a")]).limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
    assert components.components(df.limit(0)).count() == 0


def test_mix_edges(make_docs):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice("aaab") if i % 7 else None) for i in range(400)]
    rows += [(i, t, "en", "a") for i, t in EDGES]
    got = mixing.mix(make_docs(rows)).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    targets = {r.source: r.target for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6 * total
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) < 1 for s in targets)
    again = mixing.mix(make_docs(rows, parts=5)).collect()
    assert sorted((str(r.id), r.taken) for r in got) == sorted((str(r.id), r.taken) for r in again)
    assert mixing.mix(make_docs(rows).limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None)])).collect()] == [0]


def test_mix_takes_ties_in_the_same_order_for_any_partitioning(make_docs):
    rng = random.Random(13)
    # No symbols, so all have the same quality; no id or one id, so all have the same draw.
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))), "en", rng.choice("ab")) for i in [None] * 60 + [7] * 60]
    runs = [sorted((str(r.id), r.text_hash, r.source, r.taken) for r in mixing.mix(make_docs(some, parts=n)).collect())
            for some, n in ((rows, 1), (rows[::-1], 4), (rng.sample(rows, len(rows)), 7))]
    assert runs[0] == runs[1] == runs[2] and len({taken for *_, taken in runs[0]}) > 2


def test_archives_edges(spark, make_docs):
    body = "<p>" + "é" * 60 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(5, "http://a/5", body), (3, "http://a/3\r\nX: y", body), (4, None, body), (4, "http://a/4", body), (None, "u", body), (6, "u", "short"),
            (7, "u", "short"), (8, "u", None), (9, "u", ""), (10, "u", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_id", F.lit(1)).withColumn("payload", F.lit(2)).repartition(3)
    first, second = work_path(spark, "warc"), work_path(spark, "warc")
    revisits.write_archive(revisits.page_records(pages), first)
    revisits.deduplicate(spark, first, second)
    got = revisits.resolved(spark, second).collect()
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.record_type, r.refers_to_page) for r in got if r.payload_bytes > 100) == Counter(
        [(3, "response", None), (10, "response", None), (4, "revisit", 3), (4, "revisit", 3), (5, "revisit", 3), (None, "revisit", 3)])
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    files = spark.read.format("binaryFile").load(second).collect()
    text = b"".join(gzip.decompress(bytes(f.content)) for f in files)
    assert text.count(b"WARC-Type: revisit\r\n") == 4 and text.count(body.encode()) == 1
    empty = work_path(spark, "warc")
    revisits.write_archive(revisits.page_records(pages.limit(0)), empty)
    assert revisits.read_archive(spark, empty).count() == 0


def test_archives_keep_payloads_with_separators(spark):
    ends = ["", "\r", "\n", "\r\n", "\r\n\r", "\r\n\r\n", "\r\n\r\n\r\n", "\n\r\n\r\n\r"]
    rows = [(i, "u", a + "x" * n + b + "WARC/1.1\r\n" + c) for n in (0, 200_000) for i, (a, b, c) in
            enumerate(((a, b, c) for a in ends for b in ends for c in ends), n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = work_path(spark, "warc")
    revisits.write_archive(revisits.page_records(pages), path, file_records=100)
    got = {r.page_id: bytes(r.payload).decode() for r in revisits.read_archive(spark, path).collect()}
    assert got == {i: text for i, _, text in rows}
    cutter = revisits._Cutter()
    assert list(cutter.add(b"WARC/1.1\r\nContent-Length: 9")) == [] and list(cutter.add(b"abc")) == []
    with pytest.raises(ValueError):
        cutter.close()
    with pytest.raises(ValueError):
        list(revisits._Cutter().add(b"no record"))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
%s
<div id="sidebar"><p>Side</p></div><section class="comments"><p>First!</p></section><form><p>Send</p></form><!-- hidden <p>no</p> -->
<footer>&copy; Foot</footer></body></html>"""


def test_main_text_and_edges(spark, make_docs):
    article = "<article><header><h1>A &amp; B</h1></header><p>One <b>two</b>\n three<br>four<p>f&nbsp;ive &lt;x&gt;<div class='ad'>Buy</div></article>"
    plain = "<div class='content'><h1>A &amp; B</h1><p>Body %d text</p></div><div>Share this page</div>"
    rows = [(1, "http://one/1", PAGE % article), (2, None, None), (3, "not a url", ""), (4, "http://one/2", PAGE % article), (4, "http://one/2", PAGE % article)]
    rows += [(10 + i, f"http://Two:80/{i}", PAGE % (plain % i)) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("template", F.lit("y"))
    got = template.main_texts(df).collect()
    texts = {r.id: r.text for r in got}
    assert len(got) == len(rows) and texts[2] == texts[3] == ""
    assert texts[1] == texts[4] == "A & B\nOne two three four\nf ive <x>"
    # Text that a host's pages share outside of articles is template; their own text stays.
    assert all(texts[10 + i] == f"Body {i} text" for i in range(6))
    classes = template.templates(df).where("host = 'two'").collect()
    assert len(classes) > 10 and len({r["class"] for r in classes}) == 1
    assert template.main_texts(df.limit(0)).count() == 0


def test_line_templates(make_docs):
    rng = random.Random(9)
    rows = []
    # Words with digits are variable fields, so these have none.
    plain = lambda: prose(rng, 8).translate(str.maketrans("0123456789", "abcdefghij"))
    for i in range(40):
        lines = [plain(), f"Posted by user{i} on day {i} with tag {rng.choice('xyz')}", plain()]
        lines.insert(1, "All rights are reserved by the owner " + rng.choice(["Ann", "Bob"]))
        rows.append((i, "\n".join(lines)))
    rows += [(100 + (i or 0), t) for i, t in EDGES]
    got = {r.id: r for r in line_templates.drop_recurring(make_docs(rows)).collect()}
    for i in range(40):
        lines = rows[i][1].split("\n")
        assert got[i].n_dropped == 2 and got[i].text == f"{lines[0]}\n{lines[3]}"
    assert got[101].text is None and got[102].text == "" and got[104].n_dropped == 0
    assert line_templates.drop_recurring(make_docs(rows).limit(0)).count() == 0


def test_long_lines_recur_from_two_texts_on(make_docs):
    rng = random.Random(12)
    plain = lambda n: prose(rng, n).translate(str.maketrans("0123456789", "abcdefghij"))
    twice, thrice, near, copied, short = plain(60), plain(60), plain(60).split(), plain(60), plain(20)
    other = near[:30] + ["changed"] + near[31:]
    own = [plain(60) for _ in range(10)]
    shared = [[twice], [twice, thrice], [thrice], [thrice], [" ".join(near)], [" ".join(other)], [short], [short]]
    rows = [(i, "\n".join([own[i], *lines])) for i, lines in enumerate(shared)]
    rows += [(i, f"{own[8]}\n{copied}") for i in (8, 9)]  # copies of a document keep its lines
    got = {r.id: r for r in line_templates.drop_recurring(make_docs(rows)).collect()}
    assert all(got[i].text == own[i] and got[i].n_dropped == len(shared[i]) for i in range(6))
    assert all(got[i].n_dropped == 0 and got[i].text == rows[i][1] for i in range(6, 10))


def test_pipeline_stages(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(path := work_path(spark, "stage"))
        docs = spark.read.parquet(path)
        assert docs.columns == columns and docs.select("doc_id").exceptAll(before.select("doc_id")).distinct().count() <= before.count()
        if name == "exact dedup":
            table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            lower = lambda t: (t or "").translate(table)
            want = {}
            for r in before.select("doc_id", "text").collect():
                want[lower(r.text)] = max(r.doc_id, want.get(lower(r.text), -1))
            assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(want.values())
        if name == "MinHash near-dedup":
            found = brute_components([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
            assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == sorted(i for i, (_, c) in found.items() if i == c)
    assert corpus_pipeline.encode(spark, docs, SF).count() == docs.count()


def test_dedup_stages_shuffle_no_texts_if_few_rows_go(spark, make_docs):
    rng = random.Random(6)
    rows = [(i, prose(rng, 40)) for i in range(30)]
    rows += [(100, rows[0][1].upper()), (None, rows[1][1]), (101, rows[2][1] + " end"), (103, None), (104, "")]
    make_docs(rows).write.parquet(path := work_path(spark, "few"))
    docs = spark.read.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, gone in ((corpus_pipeline.exact_dedup, [0, 103, None]), (corpus_pipeline.near_dedup, [100, 101, None])):
            kept = stage(spark, docs, SF)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            left = Counter(i for i, _ in rows) - Counter(r.doc_id for r in kept.collect())
            assert left == Counter(gone)
            assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pipeline_edges(spark, make_docs):
    edges = make_docs([(i, t, "en", None) for i, t in EDGES])
    for rows in (edges, edges.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name.startswith("Sentence") or docs.columns == rows.columns
            docs.write.parquet(path := work_path(spark, "edges"))
            docs = spark.read.parquet(path)
            if name == "exact dedup":
                assert docs.count() == (0 if rows is not edges else 5)


def test_lines_are_counted_without_sorting_them(spark):
    rows = spark.createDataFrame([(7, 1, 5, 9, 2), (7, 1, 3, 9, 2), (7, 1, 4, 8, 0), (7, 1, None, 8, 0), (6, 2, 5, 9, 1)],
                                 "leaf long, key long, id long, text_hash long, line long")
    counted = line_templates._counted(rows, "leaf", "key")
    assert "SortAggregate" not in counted._jdf.queryExecution().executedPlan().toString()
    got = {(r.leaf, r.key): (r.docs, tuple(r["sample"])) for r in counted.collect()}
    assert got == {(7, 1): (2, (4, 8, 0)), (6, 2): (1, (5, 9, 1))}


def test_masked_tokens_of_whole_lines():
    tokens = ["a", "www.b", "xwww.b", "a://b", "a:", "@b.c", "@bc", "b.@", "x7", "\u0663", "\u00b2", "w", "www"]
    for a in tokens:
        for b in tokens:
            want = [line_templates.VARIABLE if line_templates._VARIABLE.search(t) else t for t in (a, b)]
            assert line_templates.masked(f" {a}\t{b} ") == want
