"""Personal data, token alignment and fill-in-the-middle against brute force, and their edge cases."""

import collections
import hashlib
import itertools
import random
import re

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessella.llm import fill_in_middle, minhash, personal_data, quality_rules, queries, token_alignment

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, found string, pairs string, n long, text_ string, plain_ int"


def table(spark, texts, start=0):
    return spark.createDataFrame([(i if i != 3 else None, t, "x", "y", 1, "z", 2) for i, t in enumerate(texts, start)], COLUMNS)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
PRIVATE = [
    "a@b.c_d@e.f x@y.z@w.v", "..@a.b. a@b", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0255 1.2.3.4.5", "4111 1111 1111 1111-", "12 4111 1111 1111 1111", "4111.1111.1111.1111 card", None, "",
    "é🙂 +1 (743) 555-3824 ok 🙂 a@b.co", "+12 +1-2 +123456789 +1....", "mail bob [at] x (dot) org, iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not GB82WEST12345698765431",
    "tel (743) 555-3824, phone 743-555-3824 x 743-555-3824 and 20 words further on there is 212-555-1234 without one of them near", "ssn 078-05-1120 / 078-05-1120-3 social 000-05-1120", "2001:0db8:85a3:0000:0000:8a2e:0370:7334 z",
    "4111-1111-1111-1111 4111-1111-1111-1111", "invoice 4111/1111/1111/1111", "a" * 5000, "1 " * 700, "1.1.1.1 " * 300, "@@a@b.c@d.e", "a@b.c " * 200, "4111 1111 1111 1111 a@b.c 4111 1111 1111 1112",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_plain_spans_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    texts = {i: t for i, t in enumerate([*PRIVATE, *(r.text for r in docs)], 10)}
    got = personal_data.digest(personal_data.find(table(spark, texts.values(), 10), "doc_id")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(written(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in PLAIN]
        spans = r.spans.split(",") if r.spans else []
        assert not set(written(want).split(",")) - {""} - set(spans) and len(spans) == len(want) + r.n_added == len(r.scores.split(",") if r.scores else [])
        order = [(personal_data.KINDS.index(k), int(a)) for k, a, _ in (x.split(":") for x in spans)]
        assert order == sorted(order)


def test_further_spans(spark):
    said = {r.doc_id: [(f.kind, f.w) for f in r.found if not f.base] for r in personal_data.find(table(spark, PRIVATE, 10), "doc_id").collect()}
    by_text = {PRIVATE[i - 10]: v for i, v in said.items()}
    assert by_text["12 4111 1111 1111 1111"] == [("card", "4111 1111 1111 1111")]
    assert by_text["4111.1111.1111.1111 card"] == [("card", "4111.1111.1111.1111")]
    assert by_text["invoice 4111/1111/1111/1111"] == []  # a word nearby lowers the score
    assert by_text[PRIVATE[10]] == [("email", "bob [at] x (dot) org"), ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert by_text[PRIVATE[11]] == [("phone", "(743) 555-3824"), ("phone", "743-555-3824"), ("phone", "743-555-3824")]
    assert by_text[PRIVATE[12]] == [("ssn", "078-05-1120")]
    assert by_text[PRIVATE[13]] == [("ip", "2001:0db8:85a3:0000:0000:8a2e:0370:7334")]
    assert by_text[PRIVATE[8]] == []  # (743) 555-3824 lies in a plain span
    added = [f for r in personal_data.find(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect() for f in r.found if not f.base]
    assert not added  # clean documents stay clean


def test_bank_account_remainders(spark):
    """The fold's remainder is that of the whole number."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    words = ["GB82WEST12345698765432", "DE89370400440532013000"] + ["".join(rng.choice("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(rng.randrange(5, 33))) for _ in range(50)]
    number = lambda w: int("".join(str(int(c, 36)) for c in w[4:] + w[:4]))
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", personal_data._mod97(F.col("w")).alias("m")).collect()
    assert {r.w: r.m for r in got} == {w: number(w) % 97 for w in words}
    assert number(words[0]) % 97 == number(words[1]) % 97 == 1


def test_personal_data_stays_in_column_functions(spark):
    plan = queries.op11_personal_data(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# token alignment

ODD = ["", None, " ", "  x", "a\n\nb\t c", "▁x", "x▁", "<s> hi </s> <unk> <0x41>", "<|endoftext|>", "a<|endoftext|>b", "é漢字🙂", "ﬁ Å Å \xa0 x", "a\x00b", "don't  ", "①②", "\r\n", "x" * 5000, "12345 67", "﻿abc", "a b c d", "a b c d", "the   end   "]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), letters


def aligned(text, libraries):
    """Ids of A and B, (a ids, b ids) of each group and the linked pairs, by token ends."""
    a, b, letters = libraries
    if not text:
        return [], [], [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_x = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
    raw_y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
    if not b"".join(raw_x) == b"".join(raw_y) == (" " + text).encode():
        return [], [], [], []
    ends = [list(itertools.accumulate(map(len, raw))) for raw in (raw_x, raw_y)]
    links = [(x[i], y[ends[1].index(e)]) for i, e in enumerate(ends[0]) if e in set(ends[1])]
    groups, before = [], 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        groups.append(([t for t, k in zip(x, ends[0]) if before < k <= e], [t for t, k in zip(y, ends[1]) if before < k <= e]))
        before = e
    return x, y, groups, links


def test_alignment_by_brute_force(spark, libraries, tmp_path):
    texts = dict(enumerate(ODD, 10)) | {100 + r.doc_id: r.text and r.text[:2000] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()}
    table(spark, texts.values(), 10).write.parquet(f"{tmp_path}/t")
    texts = dict(enumerate(texts.values(), 10))
    want = {i: aligned(t, libraries) for i, t in texts.items()}
    counts = collections.Counter(link for _, _, _, links in want.values() for link in links)
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    got = token_alignment.align_documents(spark.read.parquet(f"{tmp_path}/t"), queries.RANKS, queries.PIECES, groups=True).collect()
    assert len(got) == len(texts)
    for r in got:
        x, y, groups, links = want[r.doc_id]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        assert (r.groups, r.groups_sha256) == (text, sha(text) if x else "")
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(x), len(y), len(groups), len(links))
        assert (r.n_best, r.count_sum) == (sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links))
    assert {i for i, w in want.items() if not w[0]} == {i for i, t in texts.items() if not t or "▁" in t}
    assert len(counts) <= token_alignment.possible_pairs(queries.RANKS, queries.PIECES) == 324_300


def test_owner_arrays_by_brute_force():
    rng = random.Random(3)
    import numpy as np

    for _ in range(200):
        n = rng.randrange(1, 12)
        a, b = (np.array(sorted(rng.randrange(4) for _ in range(n))) for _ in range(2))
        pairs = list(zip(a.tolist(), b.tolist()))
        assert list(zip(*(x.tolist() for x in token_alignment.overlaps(a, b)))) == [p for k, p in enumerate(pairs) if not k or pairs[k - 1] != p]
        cut = [k for k in range(n) if k == n - 1 or (a[k] != a[k + 1] and b[k] != b[k + 1])]
        assert token_alignment.cut_places(a, b).tolist() == cut


def test_models_that_split_at_blanks(libraries):
    """Stretches of blanks and signs give what whole texts give."""
    texts = [t for t in ODD if t and "▁" not in t] + ["a  b   c", " lead", "trail ", "   ", "a ", "a  ", "a\n "]
    assert token_alignment._splits(queries.PIECES)
    ids, counts = token_alignment._piece_ids(texts, queries.PIECES)
    assert [ids[e - c : e].tolist() for c, e in zip(counts.tolist(), counts.cumsum().tolist())] == [libraries[1].encode(t) for t in texts]


def test_alignment_of_nothing(spark):
    assert token_alignment.align_documents(table(spark, []), queries.RANKS, queries.PIECES).count() == 0
    one = token_alignment.align_documents(table(spark, ["", None, ""]), queries.RANKS, queries.PIECES).collect()
    assert [tuple(r)[1:] for r in one] == [(0, 0, 0, 0, 0, "", 0, 0)] * 3


# fill in the middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def turned(ident, text):
    units = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


FIM = ["", None, " ", " \n ", "a", " a", "a ", "a b\tc\n\nd  ", "é漢字🙂 é \x0b x", "<P> x", "x <S", "x<S><M>", "<<P", "P><", "  nbsp   em", "x" * 300, "w " * 4000, "a b c", "a b c"] + ["one two  three\nfour five "] * 60


def test_fill_in_middle_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(i if i != 3 else None, t) for i, t in enumerate(FIM)] + [(r.doc_id + 1000, r.text) for r in docs]
    got = fill_in_middle.transform(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, form string"), texts=True).collect()
    want = [(i, *turned(i, t or "")) for i, t in rows]
    mine = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got]
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(mine, key=key) == sorted(want, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    texts = {i: t or "" for i, t in rows}
    assert all(r.restored_sha256 == sha(texts[r.doc_id]) and r.output_sha256 == sha(r.output) for r in got)
    assert fill_in_middle.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bits_by_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        data = bytes(rng.choice(b"ab \n") for _ in range(rng.randrange(30)))
        ends = [m.end() for m in TOKEN.finditer(data.decode())]
        mask = fill_in_middle.token_ends(data)
        assert [k + 1 for k in range(len(data)) if mask >> (len(data) - 1 - k) & 1] == ends and mask.bit_count() == len(ends)
        assert [fill_in_middle.select(mask, len(data), k + 1) + 1 for k in range(len(ends))] == ends
        n, a, b = fill_in_middle.cuts(data, 5, 11)
        at = [0, *ends]
        assert (n, a, b) == (len(ends), *sorted((at[5 % (n + 1)], at[11 % (n + 1)])))
    for form in ("plain", "psm", "spm"):
        for data in (b"<x<P", b"<<S", b"M>", "é".encode()):
            assert all(fill_in_middle.restore(fill_in_middle.arrange(data, form, a, b), form) == data for a in range(len(data) + 1) for b in range(a, len(data) + 1) if not any(m in data for m in (b"<P>", b"<S>", b"<M>")))


# fences of the quality rules


def test_fences_move_with_their_group(spark):
    """Symbols that are usual in one source are outliers in another one, and so are long words; a group of equal texts keeps its small differences."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    prose = lambda n, long=5, signs=0: " ".join(word(rng.randrange(long - 2, long + 3)) + ("#" if rng.random() < signs else "") for _ in range(n))
    same = prose(150)
    rows = [(s, t) for _ in range(220) for s, t in (("plain", prose(150)), ("marked", prose(150, signs=0.2)), ("long", prose(110, long=11).replace(" ", "\n", 6)), ("copies", same))]
    probes = {"plain": [prose(150, signs=0.2), prose(150, long=11), prose(150) + " #"], "marked": [prose(150, signs=0.2), prose(150, signs=0.95)], "long": [prose(150, long=11), prose(150)], "copies": [same + " abc def", same[:-3], prose(150, signs=0.5)]}
    rows += [(s, t) for s, ts in probes.items() for t in ts]
    df = spark.createDataFrame([(i, t, "en", s) for i, (s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.kept for r in quality_rules.judge(df).collect()}
    verdicts = [out[i] for i in range(880, len(rows))]
    assert verdicts == [False, False, True, True, False, True, False, True, True, False]
    assert sum(out[i] for i in range(880)) >= 0.99 * 880
    limits = {r.source: r for r in quality_rules.fences(quality_rules.counts(df, ["lang", "source"])).collect()}
    for k in quality_rules.RATES:
        assert len({round(r[f"{k}_high"], 9) for r in limits.values()}) > 1, k


def test_fences_keep_good_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    out = [(labels[r.doc_id], r.kept) for r in quality_rules.judge(docs).collect() if not r.base_failed and labels.get(r.doc_id) is not None]
    good, poor = ([kept for q, kept in out if q == x] for x in (1, 0))
    assert sum(good) >= 0.995 * len(good) and sum(poor) <= 0.02 * len(poor)


def test_rows_that_go_by_either_way(spark, monkeypatch, tmp_path):
    """Few ids are sent to the texts, many meet them in a shuffle: the same rows stay."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(k, f"{base} {k // 3}" if k % 2 else f"text {k} of its own with some more words {k * 7}") for k in range(30)] + [(None, base), (None, f"{base} 0"), (5, "another text under the same id as an earlier one"), (5, f"{base} 1"), (40, None), (41, "")]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, id_ int").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    few = sorted(map(str, minhash.keep(docs).collect()))
    monkeypatch.setattr(minhash, "GONE", 0)
    assert sorted(map(str, minhash.keep(docs).collect())) == few and 15 < len(few) < len(rows)
