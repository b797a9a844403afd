"""Fertility rules, the Merkle manifest and whitening against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from airgrid.llm import fertility, manifest, queries, whitening
from airgrid.llm.numbering import numbered

from .data import documents, prose, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARIES = queries.vocabularies()


# Fertility

ODD = [
    None, "", " \n\t ", "a", "a a a a", "one two three one two three", "x\n\n x\nx\n x\nx", "日本語のテキスト 日本", "Привет мир, привет",
    "tab\x0bvt\x0cff\rcr nbsp here em space", "\U0001f600 <b>&amp;</b> $5 50% *#|", "a" * 3000, "ab" * 500 + " end", "α β γ abc",
    " ".join(f"w{i}" for i in range(3000)), " ".join(["same"] * 200), "é combining ퟿ edge",
]


def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def plain_measures(text):
    words = WORD.findall(text or "")
    pieces = SentencePieceProcessor(model_file=VOCABULARIES[0])
    known = fertility.Vocabularies(*VOCABULARIES)
    ids = [i for w in words for i in pieces.encode(w)]
    n_bytes = sum(len(known.bytes.encode_ordinary(" " + w)) for w in words)
    chars, n = sum(map(len, words)), len(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
    return chars / max(n, 1), chars / max(n_bytes, 1), sum(map(pieces.is_byte, ids)) / max(n, 1), entropy


def test_counts_and_measures_are_those_of_single_texts():
    known = fertility.Vocabularies(*VOCABULARIES)
    texts = ODD + [r[1] for r in rows()]
    found = fertility.measured_texts(texts, known)
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in fertility.COUNTS) == plain_base(text), text
        assert [float(found[m][i]) for m in fertility.MEASURES] == pytest.approx(plain_measures(text), abs=1e-9), text


def test_measures_depend_on_the_text_alone(monkeypatch):
    texts = ODD + [r[1] for r in rows()]
    together = fertility.measured_texts(texts, fertility.Vocabularies(*VOCABULARIES))
    monkeypatch.setattr(fertility, "REMEMBERED", 40)
    known = fertility.Vocabularies(*VOCABULARIES)
    alone = [fertility.measured_texts([t], known) for t in texts]
    assert len(known.known) <= 3000  # of one text, when more than are remembered
    for name in [*fertility.COUNTS, *fertility.MEASURES, "script", "n_pieces"]:
        assert [x[name][0] for x in alone] == list(together[name])


def test_an_encoder_remembers_a_bounded_number_of_words():
    known = fertility.Vocabularies(*VOCABULARIES)
    for k in range(0, 400_000, 50_000):
        known.numbers([f"q{i:x}" for i in range(k, k + 50_000)])
        assert len(known.known) <= fertility.REMEMBERED and len(known.ids) == known.first[-1]


def test_words_are_encoded_together_and_once(monkeypatch):
    """Also where white space other than blanks, marks or quotes stand in a word or at its edges."""
    odd = ["b\u3000c", "\u3000", "x\u3000", "\u2009y", "c\x85", "\x85", "d\xa0\xa0", "e\x1c\x1d", "'s", "it's", "'tis", "x's'S", "\xad", "a\u200bb", "\ufeff", "\U0001f600x", "\x00", "a\u2028b"]
    words = list(dict.fromkeys([*odd, *(w for r in rows() for w in WORD.findall(r[1] or "")), *(f"w{i:x}" for i in range(60_000))]))
    known = fertility.Vocabularies(*VOCABULARIES)
    expected = [len(known.bytes.encode_ordinary(" " + w)) for w in words]
    calls, whole = [], tiktoken.Encoding.encode_ordinary
    monkeypatch.setattr(tiktoken.Encoding, "encode_ordinary", lambda self, text: calls.append(text) or whole(self, text))
    places = known.numbers(words)
    assert known.n_bytes[places].tolist() == expected and set(calls) <= {" " + w for w in words if not w.isprintable()}
    for i in range(60_000, 150_000, 30_000):
        known.numbers([f"w{k:x}" for k in range(i, i + 30_000)])
    learnt, before = [], known._learn
    monkeypatch.setattr(known, "_learn", lambda new: learnt.extend(new) or before(new))
    assert (known.numbers([*words, "new word"]) == [*places, len(known.known) - 1]).all() and learnt == ["new word"]


def test_an_encoder_starts_anew_beyond_its_bound(monkeypatch):
    monkeypatch.setattr(fertility, "REMEMBERED", 1000)
    known = fertility.Vocabularies(*VOCABULARIES)
    for k in range(0, 5000, 400):
        words = [f"q{i:x}" for i in range(k, k + 500)]
        places = known.numbers(words)
        assert len(known.known) <= 1000 and len(known.ids) == known.first[-1] and len(known.n_bytes) == len(known.known)
        assert known.ids[known.first[places[7]] : known.first[places[7] + 1]].tolist() == known.pieces.encode(words[7])


def test_scripts():
    texts = ["abc где", "где абв a", "日本 漢字", "ひらがな", "한국어", "12 -- ?", "", "αβγ abc", "éàü × ÷"]
    found = fertility.measured_texts(texts, fertility.Vocabularies(*VOCABULARIES))["script"]
    assert found == ["Latin", "Cyrillic", "Han", "Kana", "Hangul", "none", "none", "Latin", "Latin"]


def test_many_distinct_words_take_the_wide_path():
    codes = np.array([0, 1, 2, 0, 1, 2, 5, 6], np.int64)
    assert fertility.repeated_words(codes) == fertility.repeated_words(codes * (1 << 20)) == 6


def plain_bands(measured, least, fence):
    cells = {}
    for r in measured:
        if r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]:
            continue
        for key in [r["script"]] + ([f"{r['script']}/{r['lang']}"] if r["lang"] is not None else []):
            for m, (bins, _, _) in fertility.MEASURES.items():
                cells.setdefault((key, plain_cell(m, r)), (m, []))[1].append(math.floor(r[m] * bins))
    out = {}
    for at, (m, values) in cells.items():
        if len(values) >= least:
            bins, narrow, below = fertility.MEASURES[m]
            q1, q3 = np.quantile(values, [0.25, 0.75])
            q1, q3 = q1 / bins, (q3 + 1) / bins
            reach = fence * max(q3 - q1, narrow)
            out[at] = (q1 - reach if below else -math.inf, q3 + reach)
    return out


def plain_cell(m, r):
    return f"{m}/{math.floor(math.log2(max(r['n_pieces'], 1)))}" if m == "token_entropy" else m


def test_rules_and_bands(spark, work):
    docs = documents(spark)
    got = fertility.apply_rules(docs, work, *VOCABULARIES, least=8, fence=0.5)
    measured = [r.asDict() for r in fertility.measure(docs, *VOCABULARIES).collect()]
    bands = plain_bands(measured, 8, 0.5)
    expected = Counter()
    for r in measured:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        outside = []
        for m in fertility.MEASURES:
            own = f"{r['script']}/{r['lang']}" if r["lang"] is not None else r["script"]
            band = bands.get((own, plain_cell(m, r))) or bands.get((r["script"], plain_cell(m, r)))
            if band and not band[0] <= r[m] <= band[1]:
                outside.append(m)
        expected[r["doc_id"], *(r[c] for c in fertility.COUNTS), failed, not failed and not outside] += 1
    result = Counter((r["doc_id"], *(r[c] for c in fertility.COUNTS), r["base_failed"], r["kept"]) for r in got.collect())
    assert result == expected
    assert {k[-1] for k in result if not k[-2]} == {True, False}


def test_rules_of_an_empty_table(spark, work):
    got = fertility.apply_rules(documents(spark, []), work, *VOCABULARIES)
    assert got.count() == 0 and "kept" in got.columns


def test_rules_keep_good_documents(spark, work):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in fertility.apply_rules(docs, work, *VOCABULARIES).collect() if not r["base_failed"]]
    good = [r["kept"] for r in got if labels.get(r["doc_id"]) == 1]
    assert sum(good) >= 0.99 * len(good)


# Numbering and manifest

def test_positions_with_hot_groups_and_equal_rows(spark, work):
    data = [("a" if i % 3 else "b", i // 4) for i in range(2000)] + [("c", 5)] * 300 + [("d", None)]
    table = spark.createDataFrame(data, "g string, k int").repartition(13)
    got = numbered(table, "g", ["k"], work).collect()
    for g in "abcd":
        mine = sorted((r["pos"], r["k"]) for r in got if r["g"] == g)
        expected = sorted((k for x, k in data if x == g), key=lambda k: (k is not None, k))
        assert mine == list(enumerate(expected)) and {r["total"] for r in got if r["g"] == g} == {len(expected)}


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes):
    """The root and, per bottom node, the levels of (left, right) siblings."""
    ways, level, at = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(level) > 1:
        for i, p in enumerate(at):
            begin = p // 3 * 3
            ways[i].append((level[begin:p], level[p + 1 : begin + 3]))
        level, at = [digest("".join(level[i : i + 3])) for i in range(0, len(level), 3)], [p // 3 for p in at]
    return level[0], ways


def plain_manifest(docs):
    groups = {}
    for d in docs:
        groups.setdefault((d[1] is not None, (d[1] or "").encode()), []).append((d[0] is not None, d[0] or 0, plain_leaf(*d), d))
    order, out = sorted(groups), []
    subs = [plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    if not subs:
        return []
    root, tops = plain_tree([s[0] for s in subs])
    for s, (subroot, ways), top in zip(order, subs, tops, strict=True):
        for (_, _, leaf, d), way in zip(sorted(groups[s], key=lambda x: x[:3]), ways, strict=True):
            node = leaf
            if d[0] is not None and d[4] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0:
                node = plain_leaf(*d[:4], d[4].replace("\n", ""))
            for left, right in way + top:
                node = digest("".join([*left, node, *right]))
            proof = digest("".join(h for left, right in way + top for h in left + right))
            out.append((d[0], leaf, subroot, root, proof, node, node == root))
    return out


def manifest_rows(n):
    return [(i, f"text {i}\nsecond line" if i % 3 else f"text {i}", "en", f"s{i % 2}" if i % 5 else None, i, None, None, None, None) for i in range(n)]


@pytest.mark.parametrize("data", [
    rows(), manifest_rows(1), manifest_rows(2), manifest_rows(4), manifest_rows(90), manifest_rows(1900),
    [(i, "é\n" * (i % 4), None, f"h{i}" if i % 2 else "", None, None, None, None, None) for i in range(100)],
], ids=["odd", "1", "2", "4", "90", "1900", "hosts"])
def test_manifest(spark, work, data):
    got = manifest.tampering(documents(spark, data), work).collect()
    expected = plain_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in data])
    assert Counter(map(tuple, got)) == Counter(expected)


def test_manifest_of_an_empty_table(spark, work):
    got = manifest.tampering(documents(spark, []), work)
    assert got.collect() == [] and got.columns == [c.split()[0] for c in manifest.REPORT.split(", ")]


def test_only_some_levels_are_written_and_proofs_lead_to_the_root(spark, work):
    docs = documents(spark, manifest_rows(1900))
    made = manifest.build(manifest.document_leaves(docs, F.lit(False), F.col("text")), work)
    assert len(made.documents.levels) == 3  # 760 leaves a source: levels 0, 3 and 6 of 7
    assert made.documents.levels[1].selectExpr("sum(size(nodes))").first()[0] == 29 + 29 + 15
    wanted = F.exists("nodes", lambda x: x["doc_id"] == 77)
    proofs = manifest.proofs(made, work, wanted).collect()
    assert 0 < len(proofs) <= manifest.SPAN and 77 in {r["doc_id"] for r in proofs}
    whole = manifest.verification(made, work).where("doc_id = 77").first()
    proof = next(r for r in proofs if r["doc_id"] == 77)
    assert digest("".join(proof["proof"])) == whole["proof_sha256"] and whole["verified"]


def test_ways_up_round_trip():
    nodes = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    levels = manifest.regenerate(nodes, whole=True)
    assert [len(x) for x in levels] == [20, 7, 3, 1]
    for i, node in enumerate(nodes):
        assert manifest.fold(node, manifest.siblings(manifest.way_up(levels, i))) == levels[-1][0]
    assert [len(x) for x in manifest.regenerate(nodes[:1], whole=False)] == [1, 1, 1, 1]


# Whitening

def test_factor_and_rotations_give_eigenpairs():
    rng = np.random.default_rng(3)
    for n, rank in ((1, 1), (2, 2), (5, 3), (16, 16), (33, 20), (7, 0)):
        half = rng.normal(size=(n, rank)) * np.logspace(0, -5, max(rank, 1))[:rank]
        a = half @ half.T
        factor, order = whitening.pivoted_cholesky(a)
        assert np.allclose((factor @ factor.T), a[np.ix_(order, order)], atol=1e-12)
        values, components = whitening.principal(a)
        true = np.linalg.svd(half, compute_uv=False)[:rank] ** 2
        assert len(values) == rank and np.allclose(values, true, rtol=1e-8)
        assert np.allclose(components.T @ components, np.eye(rank), atol=1e-9)
        assert np.allclose(a @ components, components * values, atol=1e-12)


def plain_whitening(table):
    """vec_id, x of the rows that take part, the distinct matrix, its covariance."""
    used = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in table if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in used), default=0)
    used = [(i, x + [0] * (width - len(x))) for i, x in used]
    fit = sorted({tuple(x) for _, x in used})
    return used, fit


def check_whitening(got, table, k=4):
    used, fit = plain_whitening(table)
    n, matrix = len(fit), np.array(fit, float)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = matrix - matrix.mean(0)
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, matrix.shape[1])
    expected = Counter((i, c) for i, _ in used for c in range(1, k + 1))
    assert Counter((r["vec_id"], r["component"]) for r in got) == expected
    deviation = Counter((i, sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))) for i, x in used)
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == deviation
    assert {r["n"] for r in got} == {n}
    by_vector = {}
    for r in got:
        by_vector.setdefault((r["vec_id"], r["deviation"], r["component"]), set()).add(r["whitened"])
    for c in range(1, k + 1):
        signs = set()
        for i, x in used:
            dev = sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True))
            want = float((np.array(x) - matrix.mean(0)) @ vectors[:, c - 1] / math.sqrt(values[c - 1]))
            have = by_vector[i, dev, c]
            if abs(want) > 1e-6:
                signs |= {round(v / want, 6) for v in have} if len(have) == 1 else set()
        assert signs in ({1.0}, {-1.0})
        share = values[c - 1] / np.trace(cov)
        assert all(r["explained"] == pytest.approx(share, rel=1e-9) for r in got if r["component"] == c)
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9


def vector_rows(n, width, seed=0):
    rng = np.random.default_rng(seed)
    scale = np.linspace(1, 0.2, width)
    return [(i, [float(v) for v in rng.normal(size=width) * scale]) for i in range(n)]


def test_whitening(spark, work):
    table = vector_rows(300, 9)
    table += [table[5], (901, table[7][1]), (None, table[8][1]), (902, None), (903, [1.0, None] + [0.0] * 7), (904, [math.inf] * 9), (905, [math.nan] * 9)]
    table += [(906, [0.5, -0.5]), (907, [])] + [(1000 + i, table[0][1]) for i in range(200)]
    extra = "vec_id long, embedding array<float>, x int, i string, row string, Share int"
    got = whitening.whiten(spark.createDataFrame([(*r, 1, "a", "b", 2) for r in table], extra).repartition(5), work).collect()
    check_whitening(got, table)


def test_whitening_is_equal_on_any_partitioning(spark, work):
    table = spark.createDataFrame(vector_rows(500, 12), "vec_id long, embedding array<float>")
    one, many = (sorted(map(tuple, whitening.whiten(table.repartition(n), work).drop("identity_error").collect())) for n in (1, 9))
    assert one == many


@pytest.mark.parametrize("table", [
    [], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, []), (2, [])],
], ids=["empty", "null", "one", "copies", "no entries"])
def test_whitening_without_variance(spark, work, table):
    got = whitening.whiten(spark.createDataFrame(table, "vec_id long, embedding array<float>"), work).collect()
    used = [r for r in table if r[1]]
    assert len(got) == 2 * len(used)
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["n"] == 1 and r["deviation"] == 0 for r in got)


def test_whitening_with_less_rank_than_components(spark, work):
    table = [(i, [float(i), 2.0 * i, 0.0, 1.0]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame(table, "vec_id long, embedding array<float>"), work).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert {(r["component"], round(r["explained"], 12)) for r in got} == {(1, 1.0), (2, 0.0), (3, 0.0), (4, 0.0)}


def test_deviations_are_exact_and_null_beyond_a_long():
    fitted = whitening.Whitening(10**6, [3, -5], 1.0, np.ones(2), np.eye(2))
    x = np.array([[2**11, -7], [2**20, 1], [2**40, 0]])
    expected = [sum((10**6 * int(v) - s) ** 2 for v, s in zip(r, [3, -5], strict=True)) for r in x]
    assert fitted.deviations(x) == [v if v < 2**63 else None for v in expected]
    assert fitted.deviations(x[:1]) == expected[:1]


def test_long_prose_is_one_text():
    text = prose(1, 60_000)
    found = fertility.measured_texts([text], fertility.Vocabularies(*VOCABULARIES))
    assert found["n_words"][0] == len(text.split()) and isinstance(fertility.Vocabularies(*VOCABULARIES).bytes, tiktoken.Encoding)
