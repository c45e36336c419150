"""The operators as Spark jobs: awkward tables, brute force, and the registered statements."""

import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, htmlmain, langid, linededup, pii, quality, queries, sentencepieces, simhash, tokencount, topk
from shelfspark.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, _row string, n_words string, fingerprint string, ids string, spans string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))


def awkward(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, columns with the operators' own names."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "Same text here, and some more words to count."), (5, "Same text here, and some more words to count."),
            (None, "A row without an id, but with text: a@b.ch"), (6, "12345 67890"), (7, "Same text here, and some more words to count."), (None, None)]
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None, None, "s", "r", "n", "f", "i", "p") for i, t in rows], DOCS).repartition(3)


def labels_of(spark, rows=((1, 1), (4, 1), (5, 1), (6, 0), (7, None), (None, 0), (2, 0), (2, 1))):
    return spark.createDataFrame([(k, q, 0) for k, q in rows], "doc_id long, quality int, toxic int")


def benchmark_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: quality.report(d, labels_of(s)),
    "tokens": lambda s, d: sentencepieces.report(d),
    "decontaminate": lambda s, d: decontaminate.report(d, benchmark_of(s, [(1, "same text here"), (None, "12345"), (2, None), (3, ""), (1, "same text here")])),
    "pii": lambda s, d: pii.report(d),
    "simhash": lambda s, d: simhash.report(d),
    "lines": lambda s, d: linededup.report(d),
    "counts": lambda s, d: tokencount.report(d),
    "language": lambda s, d: langid.report(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document_of_awkward_and_empty_tables(spark, name):
    docs = awkward(spark)
    rows = OPERATORS[name](spark, docs).collect()
    key = lambda ids: sorted(ids, key=lambda x: (x is None, x))
    assert key([r["doc_id"] for r in rows]) == key([r["doc_id"] for r in docs.collect()])
    twice = [r for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert OPERATORS[name](spark, docs.limit(0)).count() == 0


def test_operators_keep_other_columns(spark):
    docs = awkward(spark)
    kept = [
        pii.mark(docs)[0], simhash.with_fingerprint(docs)[0], tokencount.count_tokens(docs)[0], sentencepieces.encode(docs)[0],
        decontaminate.mark(docs, benchmark_of(spark, [(1, "x")]))[0], linededup.dedup(docs)[0],
        quality.score(docs, quality.Ensemble([], 0.0))[0], langid.label(docs, langid.train(docs))[0],
    ]
    for out in kept:
        assert out.columns[:len(docs.columns)] == docs.columns and len({c.lower() for c in out.columns}) == len(out.columns)
        assert out.count() == docs.count()
    for out in (simhash.keep_first(docs), linededup.remove_repeated(docs), quality.keep_good(docs, labels_of(spark)),
                decontaminate.remove_contaminated(docs, benchmark_of(spark, [(1, "12345")]))):
        assert out.columns == docs.columns and out.count() > 0


def test_benchmark_in_blocks_gives_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").unionByName(benchmark_of(spark, [(901, "the of"), (902, "and")]))
    one, names = decontaminate.mark(docs, bench)
    many, _ = decontaminate.mark(docs, bench, block_chars=2000)
    columns = ["doc_id", *names]
    assert sorted(map(str, one.select(columns).collect())) == sorted(map(str, many.select(columns).collect()))
    assert one.filter(F.col(names.n_hit) > 0).count() > 10


def plain_components(n, edges):
    root = list(range(n))
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 90)] + [tuple(map(int, rng.integers(100, 160, 2))) for _ in range(40)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges + edges[:9], "u long, v long")).collect()}
    want = plain_components(200, [e for e in edges if e[0] != e[1]])
    assert got == {i: r for i, r in enumerate(want) if r != i}


@pytest.mark.parametrize("crowd,far,tau", [(1000, 1000, 4), (4, 1000, 4), (4, 3, 4), (4, 3, 3), (4, 1000, 1)])
def test_links_connect_what_is_close(spark, crowd, far, tau):
    rng = np.random.default_rng(tau)
    centres = rng.integers(-2**63, 2**63 - 1, 6)
    prints = {int(c) for c in rng.integers(-2**63, 2**63 - 1, 150)} | {0}
    for c in centres:
        for _ in range(25):
            value = int(c)
            for bit in rng.choice(64, rng.integers(0, 4), replace=False):
                value ^= int(simhash.signed(1 << int(bit)))
            prints.add(value)
    prints = sorted(prints)
    close = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if bin((prints[i] ^ prints[j]) & (2**64 - 1)).count("1") <= tau]
    want = plain_components(len(prints), close)
    classes = spark.createDataFrame([(p, 1 + i % 3) for i, p in enumerate(prints)], "fp long, n long")
    edges = [(prints.index(r["u"]), prints.index(r["v"])) for r in simhash.links(classes, tau, crowd, far).collect()]
    assert plain_components(len(prints), edges) == want
    assert all(bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= tau for a, b in edges)


def test_groups_of_copies(spark):
    base = " ".join(f"word{i}" for i in range(400))
    near = base.replace("word399", "other")
    docs = spark.createDataFrame([(3, base), (9, near), (7, base), (4, ""), (5, None), (8, "short one"), (8, "short one")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.report(docs).collect()}
    assert got == {(3, 3), (7, 3), (9, 3), (4, 4), (5, 4), (8, 8)}
    assert sorted(r["doc_id"] for r in simhash.keep_first(docs).collect()) == [3, 4, 8]


def test_passages_stay_in_the_first_document_only(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own {i} line\n{passage}\n\nyes\nend {i}") for i in range(1, 40)] + [(50, f"a\n{passage}\nb\n{passage}"), (51, f"x\n{passage} \r\ny")]
    got = {r["doc_id"]: r for r in linededup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got[1]["text"] == rows[0][1] and got[1]["n_removed"] == 0
    # the lone "yes" next to the passage goes with it, as part of one block
    assert all(got[i]["text"] == f"own {i} line\n\nend {i}" for i in range(2, 40))
    assert got[50]["text"] == "a\nb" and got[51]["text"] == "x\ny"


def test_lines_equal_a_plain_pass(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    owner = {}
    for key, text in rows:
        for line in text.split("\n"):
            owner.setdefault(line.strip(" \t\r"), key)
    want = {}
    for key, text in rows:
        lines, gone, run = text.split("\n"), set(), []
        full = [i for i, line in enumerate(lines) if line.strip(" \t\r")]
        for i in [*full, None]:
            if i is not None and owner[lines[i].strip(" \t\r")] < key:
                run.append(i)
            else:
                if sum(len(lines[j].split()) for j in run) >= 10:
                    gone |= set(run)
                run = []
        want[key] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    assert {r["doc_id"]: r["text"] for r in linededup.report(docs).collect()} == want


def test_lines_of_several_documents_are_no_block(spark):
    a, b, c = ("alpha one two three four five", "beta one two three four five", "gamma one two three four five")
    rows = [(1, f"x\n{a}\n{b}"), (2, f"y\n{c}"), (3, f"{a}\n{c}"), (4, f"z\n{b}\nzz\n{a}"), (5, f"q\n{a}\n{b}"), (6, f"{a}\n{c}\nr"), (7, f"{b}\n{a}")]
    got = {r["doc_id"]: r["text"] for r in linededup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 3 takes lines from two documents, 7 two distant ones of one; 5 copies from 1, and 6 from 3, which owns neither line
    assert got == dict(rows) | {5: "q", 6: "r"}


def test_templates_go_and_repeated_paragraphs_stay(spark):
    menu = "<div class='c1'><div>Home</div><div>About</div></div>"
    body = "<article><p>Same quote everywhere.</p><div class=x><p>Rate this page!</p></div><p>Text {0}</p></article>"
    rows = [(i, "http://a.ch/%d" % i, menu + body.format(i)) for i in range(12)] + [(100 + i, "https://u@B.ch:80/%d" % i, menu + f"<p>Only {i}</p>") for i in range(12)]
    rows += [(200, None, menu + "<p>x</p>"), (201, "http://a.ch/z", None), (None, "", "<p>&lt;y&gt;")]
    got = {r["page_id"]: r["text"] for r in htmlmain.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Same quote everywhere.\nText {i}" for i in range(12))
    assert all(got[100 + i] == f"Only {i}" for i in range(12))
    assert (got[200], got[201], got[None]) == ("Home\nAbout\nx", "", "<y>")
    assert htmlmain.report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    entry = "<article><div class=entry><p>A long paragraph of the copied article.</p><p>And its end.</p></div></article>"
    plain = "<h1>Plain title</h1><p>A long paragraph of the page without article.</p><div><p>More of it.</p></div>"
    rows = [(i, f"http://a.ch/{i}", f"<div class=x{i}>View {i}</div>" * (i % 2) + entry) for i in range(20)]
    rows += [(100 + i, f"http://b.ch/{i}", plain) for i in range(20)] + [(200 + i, f"http://b.ch/o{i}", f"<p>Other {i}</p>") for i in range(5)]
    got = {r["page_id"]: r["text"] for r in htmlmain.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "A long paragraph of the copied article.\nAnd its end." for i in range(20))
    assert all(got[100 + i] == "Plain title\nA long paragraph of the page without article.\nMore of it." for i in range(20))


def test_templates_of_small_hosts_and_small_shares_go(spark):
    box = "<div class=b><div>Write to us</div></div>"
    rows = [(i, f"http://small.ch/{i}", f"{box}<p>Page text number {i}</p>") for i in range(4)]
    rows += [(100 + i, f"http://big.ch/{i}", (box if i < 20 else "") + f"<p>Page text number {i}</p>") for i in range(200)]
    got = {r["page_id"]: r["text"] for r in htmlmain.report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(text == f"Page text number {k % 100 if k < 200 else k - 100}" for k, text in got.items())


def test_search_of_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(50, rows[1][1]), (300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]), (304, [0.5, 0.5]), (305, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    live = [(k, np.floor(256 * np.pad(np.array(v, np.float32).astype(float), (0, 6 - len(v)))).astype(int)) for k, v in rows
            if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for at, (k, v) in enumerate(live):
        if k % 50 == 0:
            best = sorted((-int(v @ w), j, i) for i, (j, w) in enumerate(live) if i != at)[:5]
            want += [(k, rank, j, -s) for rank, (s, j, _) in enumerate(best, 1)]
    for block in (8192, 40):
        got = topk.search(table, F.col("id") % 50 == 0, block=block, sample=32, pivots=4)
        assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)
    assert topk.report(table.limit(0)).count() == 0
    assert topk.report(table.filter("vec_id in (50, 51)")).count() == 4


def test_quality_of_one_class_and_of_none(spark):
    docs = awkward(spark)
    assert {round(r["score"], 3) for r in quality.report(docs, labels_of(spark, ((4, 1), (5, 1)))).collect()} == {1.0}
    assert {r["score"] for r in quality.report(docs, labels_of(spark, ())).collect()} == {0.5}
    rules = quality.tree_rules("Tree 0\n  If (feature 0 <= 5.0)\n   If (feature 0 <= 3.0)\n    Predict: 1.0\n   Else (feature 0 > 3.0)\n    Predict: 0.0\n  Else (feature 0 > 5.0)\n   Predict: 0.0")
    assert rules == {(("chars", "<=", 5.0),), (("chars", "<=", 3.0),), (("chars", "<=", 5.0), ("chars", ">", 3.0)), (("chars", ">", 5.0),)}


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    langs = queries.QUERIES["op10_language"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert langs.filter("lang = lang_pred").count() >= 0.95 * langs.count()
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    found = queries.QUERIES["op1_quality_rules"](spark, folder).join(marks, "doc_id").filter("held_out")
    assert found.filter("quality = predicted").count() >= 0.95 * found.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_statement(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(queries.ORACLES[name]).fetchdf()[list(got.columns)]
    assert sorted(map(str, got.itertuples(index=False, name=None))) == sorted(map(str, want.itertuples(index=False, name=None)))
