"""The methods inside the numbered operators against enumeration, hot groups, clashing columns and odd tables."""

import collections
import itertools
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import WORD, components, shingles
from tessella.llm import bpe, fingerprints, html_extract, language_id, lm_scoring, minhash, oracles, packing, quality_rules, queries, token_counts, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    got = con.execute(oracles.ORACLE_SQL[name])
    cols = [d[0] for d in got.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    norm = lambda rows: sorted(tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows)
    assert norm(df.select(*cols).collect()) == norm(got.fetchall())


def test_html_doubtful_words_and_tables(spark):
    para = "The long paragraph of running text, with a clause or two, says what it has to say and then it ends here. "
    page = f"<body><article><h1>T</h1><div class='tools-list'><p>{para}</p></div><section id='related-work'><p>{para * 2}</p></section><div class='tags'><a href=a>one</a> <a href=b>two</a></div><div class='search'>Search</div><p>{para * 3}</p></article></body>"
    text = html_extract.extract(page)
    assert text.count("running text") == 6 and "one" not in text.split("\n\n")[-1] and "Search" not in text
    rows = [(1, "u", page, 5), (1, "u", page, 5), (2, None, None, 5), (None, "v", "", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract_pages(df).collect()))
    assert got == [(0, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "", 0)]
    assert html_extract.extract_pages(df.filter("page_id > 9")).count() == 0


def test_forward_backward_is_enumeration():
    rng = np.random.default_rng(2)
    k, counts = 3, np.array([4, 1, 0, 2])
    psi, trans = rng.uniform(0.1, 1, (7, k)), rng.normal(size=(k, k))
    got, at = language_id._chain(psi, np.exp(trans), counts[counts > 0]), 0
    for n in counts[counts > 0]:
        want = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=int(n)):
            # the state before the first word is any, each as likely
            w = np.exp(trans)[:, path[0]].sum() * np.prod([psi[at + i, s] for i, s in enumerate(path)]) * np.prod([np.exp(trans[a, b]) for a, b in zip(path, path[1:])])
            for i, s in enumerate(path):
                want[i, s] += w
        assert np.allclose(got[at : at + n], want / want.sum(1, keepdims=True))
        at += n


def test_kernel_is_enumerated_subsequences():
    def features(word):
        chars, out = ["^", *word, "$"], collections.Counter()
        for i, j, k in itertools.combinations(range(len(chars)), 3):
            if j - i <= toxicity.GAP + 1 and k - j <= toxicity.GAP + 1:
                out[chars[i], chars[j], chars[k]] += toxicity.DECAY ** (k - i - 2)
        return out

    words = ["idiot", "id-iot", "i.d.i.o.t", "garden", "banana", "ab"]
    f = [features(w) for w in words]
    dot = lambda a, b: sum(a[x] * b[x] for x in a)
    want = np.array([[dot(a, b) / np.sqrt(dot(a, a) * dot(b, b)) for b in f] for a in f])
    v = toxicity.word_vectors(words)
    assert np.allclose(toxicity._kernel(v, len(words), v, len(words)), want, atol=1e-5)
    assert want[0, 1] > 0.4 > want[0, 3]


def test_gapped_insults_are_caught_by_the_kernel():
    rng = random.Random(3)
    plain = ["house", "river", "walks", "under", "green", "table", "seven", "paper", "garden", "music"]
    rows = [(" ".join(rng.choices(plain, k=30)) + " you blockhead", 1) for _ in range(80)] + [(" ".join(rng.choices(plain, k=30)), 0) for _ in range(80)]
    model = toxicity.train(rows)
    # no run of four characters of the insult is left in these, so only the kernel can see it
    best = model.margins([" ".join(plain), "b-l-o-c-k-h-e-a-d", "b.l.o.c.k.h.e.a.d", "blockhead"])[:, 0]
    assert best[0] < best[1] and best[0] < best[2] and best[0] < 0 < best[3]
    low, high = model.scores([" ".join(plain), " ".join([*plain, "b-l-o-c-k-h-e-a-d"])])
    assert low < high


def test_automaton_states_and_long_texts(spark):
    words = [f"w{i % 37}" for i in range(3000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[5:900])), (3, "new w1 w2 other")], "doc_id long, text string")
    from pyspark.sql import functions as F

    whole = {r.doc_id: r for r in lm_scoring.score(df, F.col("doc_id") < 3).collect()}
    old, lm_scoring.STRETCH = lm_scoring.STRETCH, 10**9  # one left-to-right run a document
    try:
        once = {r.doc_id: r for r in lm_scoring.score(df, F.col("doc_id") < 3).collect()}
    finally:
        lm_scoring.STRETCH = old
    assert all(abs(whole[k].score - once[k].score) < 1e-9 for k in whole)
    assert whole[3].n_tokens == 5 and whole[3].n_known == 3 and whole[1].n_known == 3001
    # arcs out of every state and the failure arc's share add up to one
    tokens = np.array([1, 2, 3, 1, 2, 0], np.int64)
    first, pairs, triples = np.array([0]), np.array([0, 1, 2, 3, 1, 4]), np.array([-1, 0, 1, 2, 3, 4])
    a = lm_scoring.Automaton(tokens, first, pairs, triples, np.array([1, 2, 2, 1]), np.array([1, 2, 1, 1, 1]), np.array([1, 1, 1, 1, 1]), 0, (6, 4, 2, 2))
    assert a.begin == 1 and a.fail[1] == 0 and len(a.fail) == 1 + 4 + 5
    state, cost = a.step(np.array([a.begin]), np.array([1]))
    assert state[0] == 1 + 4 + 0 and cost[0] < 0


def test_token_files_of_many_blocks(spark, tmp_path):
    texts = ["", "a " * 300, None, "b c d", "x" * 50, "", "one two three " * 90]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    enc = __import__("tessella.llm.textops", fromlist=["encoder"]).encoder(queries.RANKS)
    want = {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    got = token_counts.count_documents(df, queries.RANKS, queries.END_OF_TEXT, block=16, span=3).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert [r.doc_no for r in sorted(got, key=lambda r: r.begin)] == list(range(len(texts)))
    with pytest.raises(ValueError):
        token_counts.write(df, f"file://{tmp_path}/t", queries.RANKS, 70_000)


def test_edits_are_located(spark):
    a = "\n".join(f"line {i} has some words to read {i * 7}" for i in range(200))
    b = a.replace("line 50 ", "new line\nline 50 ").replace("line 120 has", "line 120 had")
    df = spark.createDataFrame([(1, a, b), (2, a, a), (3, None, None), (4, b, a)], "k int, a string, b string")
    got = sorted((r.k, r.paragraph) for r in fingerprints.edits(df, "k", "a", "b").filter("changed").collect())
    assert got == [(1, 120), (4, 50), (4, 121)]
    near = fingerprints.with_likeness(fingerprints.with_tree(fingerprints.with_tree(df.fillna(""), "a", "a_"), "b", "b_"), "a_", "b_", "near")
    near = {r.k: r.near for r in near.collect()}
    assert near[2] == near[3] == 1.0 and 0.95 < near[1] == near[4] < 1


def test_fences_beyond_the_bound_of_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = sorted((r.doc_id, r.kept) for r in quality_rules.judge(docs).collect())
    monkeypatch.setattr(quality_rules, "GROUPS", 0)
    assert sorted((r.doc_id, r.kept) for r in quality_rules.judge(docs).collect()) == want


def hot_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base, passage = rng.choices(vocabulary, k=60), rng.choices(vocabulary, k=40)
    rows = []
    for _ in range(150):  # near copies
        t = list(base)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append(" ".join(t))
    shared = [" ".join(rng.choices(vocabulary, k=14) + passage + rng.choices(vocabulary, k=14)) for _ in range(150)]
    rows += shared + [f"x {' '.join(t.split()[1:])}" for t in shared[:25]]
    rows += [" ".join(rng.choices(vocabulary, k=rng.randrange(3, 50))) for _ in range(60)]
    rng.shuffle(rows)
    return rows


def test_large_groups_and_a_common_passage(spark, monkeypatch):
    for name, value in (("CHUNK", 24), ("FEW", 6), ("HUBS", 2)):
        monkeypatch.setattr(minhash, name, value)
    rows = hot_rows()
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component for r in minhash.find(df, width=4).collect()}
    assert got == components([(i, shingles(x, 4)) for i, x in enumerate(rows)], 80)


def test_packing_uses_the_program_on_documents(spark):
    counts = collections.Counter(min(len(WORD.findall(r.text or "")) * 2 + 1, 1023) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect())
    demand = np.array([counts.get(i, 0) for i in range(1025)])
    found = packing.solve(demand, 1024)
    assert (sum(use * n for use, n in found) == demand).all()
    assert sum(n for _, n in found) <= int(np.ceil((demand * np.arange(1025)).sum() / 1024)) + 5


def test_packing_solves_the_program():
    capacity, rng = 256, np.random.default_rng(5)
    sizes = np.clip(rng.lognormal(4, 1, 60_000).astype(int), 1, 255)
    demand = np.bincount(sizes, minlength=capacity + 1)
    found, bound = packing.program(demand, capacity)
    served = np.zeros(capacity + 1)
    for filling, times in found.items():
        assert times > 0 and sum(k * n for k, n in filling) <= capacity
        for k, n in filling:
            served[k] += n * times
    assert np.allclose(served, demand)
    value = sum(found.values())
    assert bound <= value <= 1.01 * bound and bound >= demand @ np.arange(capacity + 1) / capacity - 1e-9
    out = packing.solve(demand, capacity)
    assert (sum(use * n for use, n in out) == demand).all() and bound - 1e-6 <= sum(n for _, n in out) <= 1.01 * bound
    whole = sum(int(times + 1e-9) for times in found.values())
    assert whole >= 0.9 * sum(n for _, n in out)  # sequences that are whole parts of the fractional solution
    halves = np.bincount([600] * 50 + [700] * 30 + [300] * 10, minlength=1025)
    assert 75 < packing.program(halves, 1024)[1] <= 80 == sum(n for _, n in packing.solve(halves, 1024))  # the weights' bound; that of the sizes is 53


def test_quality_stage_writes_no_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tessella import session

    written, cut = [], session.cut
    monkeypatch.setattr(session, "cut", lambda df: written.append(df.schema.simpleString()) or cut(df))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.limit(3).selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars"))
    kept = collections.Counter((r.doc_id, r.text) for r in quality_rules.keep(docs).collect())
    assert written and not any("text" in x for x in written)
    monkeypatch.undo()
    judged = quality_rules.judge(docs.withColumn("doc_id", F.struct("doc_id", "text"))).filter("kept").collect()
    assert kept == collections.Counter((r.doc_id.doc_id, r.doc_id.text) for r in judged) and kept


def test_stages_on_odd_tables(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    names = ["row", "row_", "good_", "toxic_score", "toxic_score_", "node_", "id_", "set_", "salt_", "n_words", "words_", "n", "h_", "label", "kind"]
    odd = d.selectExpr("*", *[f"{i} as {c}" for i, c in enumerate(names)])
    odd = odd.unionByName(odd.limit(5)).unionByName(odd.limit(1).selectExpr(*[f"cast(null as {t}) as {c}" for c, t in odd.dtypes]))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and 0 < out.count() <= 66
        assert stage(spark, odd.filter("doc_id < 0"), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).filter("doc_id is null").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, odd.filter("doc_id < 0"), SF).count() == 0


def test_quality_rows_differ_by_nulls(spark):
    text = " ".join(f"word{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, None, "x"), (1, text, "x", None), (1, text, "x", None)], "doc_id long, text string, lang string, source string")
    assert sorted(quality_rules.keep(df).collect(), key=str) == sorted(df.collect(), key=str)


def test_bpe_decodes_what_it_encodes(spark):
    texts = ["", None, "Don't stop!  \n\n", "漢字 é 🙂 1234567", "x" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    ids = bpe.encode(df, queries.RANKS, with_ids=True)
    got = {r.doc_id: bytes(r.data) for r in bpe.decode(ids, queries.RANKS).collect()}
    assert got == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert bytes(bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), queries.RANKS).first().data) == b""
