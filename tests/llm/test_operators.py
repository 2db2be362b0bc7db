"""The numbered operators against brute force on small tables, and their edge cases."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import public_tokenizers
import pytest

from tessella.llm import bpe, fingerprints, html_extract, language_id, lm_scoring, minhash, packing, quality_rules, queries, textops, token_counts, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", None, " \n ", "a b c d e f", "A b C d e f", "a b c d e f", "one two", "one two", "x" * 5000, "Don't   stop!\n\n1234567 é ß 漢字 🙂 é", " ".join(f"w{i % 50}" for i in range(4000)), "a b c d e g"]
COLUMNS = "doc_id long, text string, lang string, source string, h_ int, bucket int, node string, score double, label string, row string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 6 else None, t, "en" if i % 2 else None, None if i % 3 else "s", 1, 2, "n", 0.5, "l", "r") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id < 0")


def test_html():
    x = html_extract.extract
    assert x(None) == x("") == x("<!-- never closed") == x("<p class='a") == ""
    assert x("<nav>m</nav><div id=sidebar><p>s, s</p></div><article><h1>T &amp; U</h1><p>One <b>two<br>three<p>four</p><div class='comments'><p>c</p></div></article><footer>f</footer>") == "T & U\n\nOne two three\n\nfour"
    assert x("<script>var p='</p><p>no'</script><p>yes") == "yes"
    assert x("<body class='has-sidebar'><form>q</form><aside>a</aside><div class=notice>n</div><div><p>Long text, with commas, and more of them, to count.</p></div>") == "Long text, with commas, and more of them, to count."
    prose = "<p>" + "Running text of a sentence or two, with commas, that goes on. " * 4 + "</p>"
    plain = prose[3:-4].strip()
    assert x(f"<body><form method=post>{prose * 3}<input name=q><label>q</label></form></body>") == "\n\n".join([plain] * 3)
    assert x(f"<div>{prose}</div><form><p>Your name, please, so that we can write to you about it.</p><input></form>") == plain
    assert x(f"<section title='the hidden valley'>{prose}</section><div hidden>{prose}</div><div class=a hidden=''>{prose}</div>") == plain
    assert x(f"<div data-t=\"a hidden b\">{prose}</div>") == plain
    for name in ("id='notice-period'", "class='subscription-model'", "id=promotion-rules", "class='menu-history'"):
        assert x(f"<article>{prose}<div {name}>{prose}</div></article>") == f"{plain}\n\n{plain}"
        assert x(f"<article>{prose}<div {name}><p>Subscribe!</p><a href=x>All of them</a></div></article>") == plain
    for name in ("class=notice", "class='cookie-notice top'", "class=menu-bar", "id=newsletter_signup", "class='side-menu sidebar'"):
        assert x(f"<article>{prose}<div {name}>{prose}</div></article>") == plain
    deep = "<div>" * 3000 + "text"
    assert x(deep) == "text"


def test_lm_brute_force(spark, docs, none):
    rows = [(r.doc_id, WORD.findall((r.text or "").translate(LOW))) for r in docs.collect()]
    train = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    c = collections.Counter()
    for i, w in rows:
        if train(i):
            x = ["\n", *w, "\n"]
            for k in range(1, len(x)):
                c[x[k],] += 1
                c[x[k - 1], x[k]] += 1
                if k > 1:
                    c[x[k - 2], x[k - 1], x[k]] += 1
    one = [v for k, v in c.items() if len(k) == 1]
    n, v, n1, n2 = sum(one), len(one), one.count(1), one.count(2)
    d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9)
    want = []
    for i, w in rows:
        x, base, score = ["\n", *w, "\n"], 0.0, 0.0
        for k in range(1, len(x)):
            c1 = c[x[k],]
            base += math.log10((c1 + 1) / (n + v + 1))
            p = (c1 - d) / n if c1 else d * v / n
            for h, g, s in (((x[k - 1],), (x[k - 1], x[k]), 200), (tuple(x[k - 2 : k]), tuple(x[k - 2 : k + 1]), 5))[: min(k, 2)]:
                p = (c[g] + s * p) / (c[h] + s)
            score += math.log10(p)
        want.append((i is None, i or 0, len(w) + 1, n, round(base, 6), round(score, 6)))
    from pyspark.sql import functions as F

    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2
    got = lm_scoring.score(docs, learn).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == sorted(want)
    assert lm_scoring.score(none, learn).count() == 0


def test_bpe_round_trip(docs, none):
    enc = textops.encoder(queries.RANKS)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, queries.RANKS).collect())
    want = []
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id is None, r.doc_id or 0, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode(none, queries.RANKS).count() == 0


def test_token_counts(docs, none):
    enc = textops.encoder(queries.RANKS)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in token_counts.count_documents(docs, queries.RANKS, queries.END_OF_TEXT).collect())
    assert got == sorted((r.doc_id is None, r.doc_id or 0, len(enc.encode_ordinary(r.text or ""))) for r in docs.collect())
    assert token_counts.count_documents(none, queries.RANKS, queries.END_OF_TEXT).count() == 0


def test_fingerprints(docs, none):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    got = {r.doc_id: r for r in fingerprints.compare(docs).collect()}
    for (has, i, t), (_, _, nxt) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 2
        r = got[i if has else None]
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest() and r.n_chars == len(t)
        assert 0 <= r.near_edited <= 1 and (r.near_next == 1) == (t == nxt)
    assert got[3].fingerprint == got[5].fingerprint != got[4].fingerprint
    assert fingerprints.compare(none).count() == 0


def test_quality_base(spark, docs, none):
    def base(t):
        w = WORD.findall(t or "")
        grams = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))

    for df in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        text = collections.Counter((r.doc_id is None, r.doc_id or 0, *base(r.text)) for r in df.collect())
        out = quality_rules.judge(df).collect()
        assert collections.Counter((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out) == text
        assert not any(r.kept and r.base_failed for r in out)
    assert quality_rules.judge(none).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "a <|endoftext|> b", "<|endoftext|", "", None, "x " * 3000 + "<|endoftext|>"]
    flat, counts = packing.encode(special, queries.RANKS)
    ends = counts.cumsum()
    assert [flat[e - c : e].tolist() for c, e in zip(counts, ends)] == [t.encode(x or "", add_special_tokens=False).ids for x in special]
    assert flat[: counts[0]].tolist() == [64, 50256, 65]
    whole = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    rows = packing.pack(docs, queries.RANKS).collect()
    seen = collections.defaultdict(list)
    for r in rows:
        ids = whole[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        seen[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, whole.values()))
    for places in seen.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(seen) <= math.ceil(sum(map(len, whole.values())) / 1024) + 1
    assert packing.pack(none, queries.RANKS).count() == 0


def test_packing_program_places_the_pieces():
    import numpy as np

    capacity, rng = 256, np.random.default_rng(3)
    sizes = np.clip(rng.lognormal(4, 1, 6000).astype(int), 1, 2000) % capacity + 1
    demand = np.bincount(sizes[sizes < capacity], minlength=capacity + 1)
    demand[1] = 5  # fewer than a sequence holds
    found = packing.solve(demand, capacity)
    assert (sum(use * int(n) for use, n in found) == demand).all()  # every piece, none twice
    assert all(use @ np.arange(capacity + 1) <= capacity for use, _ in found)
    room = []  # best-fit decreasing, piece by piece
    for size in np.repeat(np.arange(capacity + 1), demand)[::-1].tolist():
        fits = [i for i, r in enumerate(room) if r >= size]
        if fits:
            room[min(fits, key=room.__getitem__)] -= size
        else:
            room.append(capacity - size)
    assert sum(int(n) for _, n in found) <= len(room)
    assert sum(n for _, n in packing.plan(np.bincount([600, 700, 1024], minlength=1025), 1024)) == 3  # no full filling


def components(ids_sets, least):
    parent = {i: i for i, _ in ids_sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, x), (b, y) in itertools.combinations(ids_sets, 2):
        if x and y and 100 * len(x & y) >= least * len(x | y):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i: find(i) for i in parent}


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def test_near_duplicates(spark, docs, none):
    for df in (docs.filter("doc_id is not null"), spark.read.parquet(f"{SF}/documents.parquet")):
        sets = [(r.doc_id, shingles(r.text, 4)) for r in df.collect()]
        got = minhash.find(df, width=4).collect()
        assert {r.doc_id: r.component for r in got} == components(sets, 80)
        assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets}
    assert minhash.find(none).count() == 0 and minhash.keep(docs).columns == docs.columns


def test_language_and_toxicity_held_out(spark, docs, none):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op2_language_id(spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for i, r in got.items() if r.held_out and truth[i]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    tox = [r for r in queries.op3_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in tox) >= 0.9 * len(tox)
    model = language_id.train([("the cat sat on the mat " * 20, "en"), ("der hund und die katze " * 20, "de")])
    out = {r.doc_id: r for r in language_id.predict(docs, model, ["doc_id"]).collect()}
    assert out[0].lang_pred == out[1].lang_pred == "und" and out[0].score == 0
    assert language_id.predict(none, model, ["doc_id"]).count() == 0
    assert language_id.predict(docs, language_id.fit(none), ["doc_id"]).first().lang_pred == "und"
    assert toxicity.score(none, toxicity.Model(model.table[:, 0], 0.0, empty=True), ["doc_id"]).count() == 0


def test_code_switching():
    model = language_id.train([("the cat sat on the mat with that other thing " * 40, "en"), ("der hund und die katze schlafen nicht " * 40, "de")])
    assert model.label_words("the cat with that thing und die katze schlafen nicht") == ["en"] * 5 + ["de"] * 5


def test_language_of_long_words_and_texts(spark):
    import numpy as np

    en, de = "the cat sat on the mat with that other thing ", "der hund und die katze schlafen nicht "
    model = language_id.train([(en * 40, "en"), (de * 40, "de")])
    joined = lambda t, n: t.replace(" ", "") * n
    langs, _ = model.predict([joined(en, 1) + joined(de, 200), joined(de, 1) + joined(en, 200), "x " + joined(en, 1) + joined(de, 200)])
    assert langs == ["de", "en", "de"]
    # every run of every word, one by one
    table = np.random.default_rng(1).normal(size=model.table.shape).astype(np.float32)
    chunk, codes, starts, ends, *_ = language_id.words(["short " + joined(en, 3) + " ab " + joined(de, 1), "twelve " + "q" * 15])
    seen = [0] * len(starts)
    sums = np.zeros((len(starts), table.shape[1]))

    def each(rows, f):
        for r, x in zip(range(len(starts)) if rows is None else rows, f):
            seen[r] += 1
            sums[r] += table[x]

    language_id.emissions(codes, starts, ends, table, each)
    assert seen == [1 + 2 * min(n, 4) + max(0, n - 3) + max(0, n - 4) for n in (ends - starts).tolist()]
    assert np.allclose(sums, language_id.emissions(codes, starts, ends, table), atol=1e-3)
    docs = spark.createDataFrame([(1, en * 9, "en"), (2, de * 9, "de"), (3, "kissa istui matolla ja koira nukkui " * 90, "fi")], "doc_id long, text string, lang string")
    assert language_id.fit(docs, longest=1000).langs == ["de", "en", "fi"]


def test_near_duplicates_without_or_with_one_id(spark, docs):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(1, t), (None, t + " end"), (None, "some other text of a few words without an id"), (None, None), (7, t + " tail"), (7, "a text of its own with the same id as another"), (8, "one more text that stays as it is"), (None, "one more text that stays as it is")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.find(df, width=4).collect()
    assert sorted(r.component for r in got if r.component) == [1, 1, 1, 7, 8, 8]
    keep = sorted(map(tuple, minhash.keep(df, width=4).collect()), key=str)
    assert keep == sorted([rows[i] for i in (0, 2, 3, 5, 6)], key=str)
    # all rows, the one without an id too
    sets = [(10**9 if r.doc_id is None else r.doc_id, shingles(r.text, 4)) for r in docs.collect()]
    assert {10**9 if r.doc_id is None else r.doc_id: r.component for r in minhash.find(docs, width=4).collect()} == components(sets, 80)
