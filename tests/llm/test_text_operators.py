"""Operators on single texts against brute force: languages, scores, licences, pseudonyms, quality, tokens."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from conftest import FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import decision_list, language_id, lattice_lm, licenses, pseudonyms
from tablewright.llm.byte_bpe import Encoder, Vocabulary, decode_documents, digest_documents, encode_documents, read_ranks
from tablewright.llm.decision_list import (
    COUNTS, decision_column, judge_quality, learn_decision_list, text_statistics,
)
from tablewright.llm.queries import KEY, PIECES, QUERIES, RANKS, remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
has_tables = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")


def table(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rest(i, of):
    return zlib.crc32(("null" if i is None else str(i)).encode()) % of


# ---- languages


@has_tables
def test_languages_of_held_out_documents(spark):
    docs = {d["doc_id"]: d for d in table("documents")}
    found = QUERIES["op3_language_id"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (rest(r.doc_id, 3) == 1) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and len(docs[r.doc_id]["text"]) > 60]
    right = [r.lang_pred == docs[r.doc_id]["lang"] for r in held]
    assert sum(right) >= 0.97 * len(right)


def test_bundle_is_the_sum_of_bound_letters():
    text = "Aña, b"
    runs = " aña b "
    want = np.zeros(language_id.DIMENSIONS)
    vector = lambda c: language_id.letter_vectors(np.array([ord(c)]))[0].astype(int)
    for k in range(1, len(runs) - 1):
        if runs[k] != " ":
            want += np.roll(vector(runs[k - 1]), 2) * np.roll(vector(runs[k]), 1) * vector(runs[k + 1])
    assert np.array_equal(language_id.bundle([None, text, "", "12"])[1], want)
    assert not language_id.bundle([None, "", "12"]).any()


def test_languages_of_awkward_rows(awkward, no_rows, make_docs):
    found = language_id.identify_languages(awkward, F.lit(False))
    rows = {(r.doc_id, r.lang_pred) for r in found.collect()}
    assert found.count() == awkward.count()
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und"), (10, "xx"), (7, "en")} <= rows
    assert language_id.identify_languages(no_rows, F.lit(False)).count() == 0
    untaught = language_id.identify_languages(make_docs([(1, "text", None, None, 1)]), F.lit(False)).collect()
    assert [(r.lang_pred, r.score) for r in untaught] == [("und", 0.0)]
    some = [["漢字 und so", "straße"], ["漢字 und so"], ["straße"]]
    vectors = [language_id.bundle(t) for t in some]
    assert np.array_equal(vectors[0][0], vectors[1][0]) and np.array_equal(vectors[0][1], vectors[2][0])


# ---- likelihood


def lattice(word, pieces):
    """Sum over all segmentations, one by one."""

    def ways(at):
        if at == len(text):
            return [0.0]
        out, single = [], False
        for end in range(at + 1, len(text) + 1):
            score = pieces.get(text[at:end])
            if score is not None:
                single = single or end == at + 1
                out += [score + w for w in ways(end)]
        if not single:
            out += [sum(pieces[f"<0x{b:02X}>"] for b in text[at].encode()) + w for w in ways(at + 1)]
        return out

    text = "▁" + word
    return math.log(sum(map(math.exp, ways(0))))


def test_lattice_sums_all_segmentations():
    pieces = lattice_lm.read_pieces(PIECES)
    assert abs(sum(map(math.exp, pieces.values())) - 1) < 1e-9
    words = ["the", "onineheat", "é漢x", "😀", "a", "", "zz|#", "queçier"]
    got = lattice_lm.Lattice(pieces).log_probabilities([w.encode() for w in words])
    assert np.allclose(got, [lattice(w, pieces) for w in words], rtol=0, atol=1e-9)


def expected_scores(docs):
    pieces = lattice_lm.read_pieces(PIECES)
    tokens = [WORD.findall((t or "").translate(LOWER)) for _, t in docs]
    count = Counter()
    for (i, _), words in zip(docs, tokens):
        if rest(i, 7) != 2:
            count.update(words)
            count["\n"] += 1
    n, v = sum(count.values()), len(count)
    p_end = (count["\n"] + 1) / (n + 2)
    out = []
    for (i, _), words in zip(docs, tokens):
        every = [*words, "\n"]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in every)
        score = (sum(LATTICE(w, pieces) + math.log(1 - p_end) for w in words) + math.log(p_end)) / math.log(10)
        out.append((i, rest(i, 7) == 2, len(every), sum(count[w] > 0 for w in every), n, base, score))
    return out


def LATTICE(word, pieces, known={}):  # noqa: B006
    if word not in known:
        known[word] = float(lattice_lm.Lattice(pieces).log_probabilities([word.encode()])[0])
    return known[word]


def check_scores(got, want):
    key = lambda r: repr((r[0], r[2], round(r[6], 4)))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("frequent", [1 << 18, 4])
def test_scores_match_brute_force(awkward, no_rows, make_docs, monkeypatch, frequent):
    monkeypatch.setattr(lattice_lm, "FREQUENT", frequent)  # with 4, most words go through the join
    rows = [(r.doc_id, r.text) for r in awkward.select(awkward["*"]).toDF(*[f"c{i}" for i in range(len(awkward.columns))]).selectExpr("c0 doc_id", "c1 text").collect()]
    check_scores(lattice_lm.score_texts(awkward, remainder(7, 2), PIECES).collect(), expected_scores(rows))
    assert lattice_lm.score_texts(no_rows, remainder(7, 2), PIECES).count() == 0
    only_held_out = lattice_lm.score_texts(make_docs([(1, "a b", None, None, 1)]), F.lit(True), PIECES).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in only_held_out] == [(0, 0, 0.0)]


def test_expected_counts_match_all_segmentations(monkeypatch):
    pieces = {"▁": -1.5, "▁a": -1.0, "a": -2.0, "ab": -1.7, "b": -2.2, "é": -3.0} | {f"<0x{b:02X}>": -6.0 for b in range(256)}

    def ways(text):
        if not text:
            return [(0.0, [])]
        out = [(pieces[p] + s, [p, *rest]) for n in range(1, len(text) + 1) if (p := text[:n]) in pieces for s, rest in ways(text[n:])]
        spelt = [] if text[0] in pieces else [f"<0x{b:02X}>" for b in text[0].encode()]
        return out + ([(sum(map(pieces.get, spelt)) + s, [*spelt, *rest]) for s, rest in ways(text[1:])] if spelt else [])

    words = ["ab", "aabab", "é漢a", "", "bb", "xab"]
    want = Counter()
    for word in words:
        found = ways("▁" + word)
        total = math.log(sum(math.exp(s) for s, _ in found))
        for s, path in found:
            want.update(dict.fromkeys(path, 0.0))
            for p in path:
                want[p] += math.exp(s - total)
    lattice = lattice_lm.Lattice(pieces)
    for long in (256, 1):  # with 1, each word goes through the recursion alone
        monkeypatch.setattr(lattice_lm, "LONG_WORD", long)
        got = lattice.expected_counts([w.encode() for w in words])
        assert np.allclose(got, [want[n] for n in lattice.names], rtol=0, atol=1e-9)


def test_held_out_texts_are_as_likely_as_their_words(make_docs):
    rng = random.Random(4)
    parts = ["tho", "rem", "éch", "und", "ly", "ain", "ost", "wha", "ñi", "br"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
    frequent = [word() for _ in range(60)]
    texts = [" ".join(rng.choice(frequent) if rng.random() < 0.95 else word() for _ in range(80)) for _ in range(300)]
    docs = make_docs([(i, t, None, None, len(t)) for i, t in enumerate(texts)])
    held = [r for r in lattice_lm.score_texts(docs, remainder(7, 2), PIECES, learn=True).collect() if r.held_out]
    assert len(held) > 20 and all(math.isfinite(r.score) for r in held)
    assert sum(r.score for r in held) > 1.05 * sum(r.base_score for r in held)


# ---- licences


def test_licences_match_brute_force(awkward, no_rows):
    rows = {}
    for r in licenses.scan_licenses(awkward).collect():
        rows[r.doc_id] = r
    assert rows[12].base_labels == "apache-2,mit" and rows[12].n_base == 2
    assert (rows[12].first_word, rows[12].last_word) == (1, 8)
    assert rows[13].base_labels == "apache-2,cc-by-nc" and rows[13].labels == "apache-2,cc-by-nc,gpl-3"
    assert (rows[13].first_word, rows[13].last_word) == (2, 8)
    for i in (1, 2, 3, 7):
        assert (rows[i].n_base, rows[i].first_word, rows[i].labels, rows[i].score) == (0, None, "", 0.0)
    assert rows[1].n_words == 0 and rows[10].n_words == 4
    assert licenses.scan_licenses(no_rows).count() == 0


@has_tables
def test_every_notice_line_gets_a_label():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    lines = {line for d in table("documents") for line in (d["text"] or "").split("\n")}
    notices = {x for x in lines if re.search(r"licen[sc]e|copyright|rights reserved|permission", x, re.I)}
    notices |= {"All rights reserved.", "This work is licensed under the GNU General Public License, version 3."}
    for line in notices:
        _, base, more = scanner.scan(line.encode())
        assert base or more, line
    wordings = ["All rights reserved.", "Copyright (c) 2020 Some Body. All rights reserved.", "Copyright 2020 Some Body, all rights reserved"]
    for line in wordings:
        _, _, more = scanner.scan(line.encode())
        assert {m.label for m in more} == {"proprietary"}
        assert min(m.start for m in more) == 0 and any(m.end - m.start == m.exact for m in more)
    assert scanner.scan(b"all rights are reserved")[2] == []


def as_regex(template):
    out = ""
    for part in re.findall(r"<<[^>]*>>|[^<\s]+", template):
        if part == "<<beginOptional>>":
            out += "(?:"
        elif part == "<<endOptional>>":
            out += ")?"
        elif m := re.fullmatch(r"<<var;(\d+)>>", part):
            out += rf"(?:\S+ ){{1,{m[1]}}}"
        else:
            out += re.escape(part) + " "
    return re.compile(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("a b c x y".split()), max_size=9))
def test_template_automata_accept_what_the_regex_does(words):
    for template in (
        "a <<beginOptional>>b<<endOptional>> c",
        "a <<var;2>> c <<beginOptional>><<var;1>> x<<endOptional>>",
        "<<beginOptional>>a b<<endOptional>> <<beginOptional>>x<<endOptional>> c <<beginOptional>>y <<beginOptional>>y<<endOptional>><<endOptional>>",
        "a b <<var;3>>",
    ):
        automaton, pattern = licenses.compile_template("l", template), as_regex(template)
        for at in range(len(words)):
            text = "".join(w + " " for w in words[at:])
            longest = max(
                (k for k in range(len(words) - at + 1) if k and pattern.fullmatch("".join(w + " " for w in words[at : at + k]))),
                default=None,
            )
            found = automaton.longest([w.encode() for w in words], at)
            assert (found and found[0] - at) == longest, (template, text)


def test_templates_that_fix_nothing_are_refused():
    for bad in ("", "<<var;3>>", "<<beginOptional>>a<<endOptional>>", "a <<endOptional>>", "a <<what>>"):
        with pytest.raises((ValueError, IndexError)):
            licenses.compile_template("l", bad)


# ---- pseudonyms


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5000), st.data())
def test_permutation_has_an_inverse(size, data):
    x = data.draw(st.integers(0, size - 1))
    y = pseudonyms.permute(x, size, b"k", "t")
    assert 0 <= y < size and pseudonyms.unpermute(y, size, b"k", "t") == x


def test_permutation_is_one_to_one():
    for size in (1, 2, 3, 10, 97, 1000):
        assert sorted(pseudonyms.permute(x, size, b"k", "t") for x in range(size)) == list(range(size))


#: Valid values of each kind.
VALUES = {
    "card": ["4111 1111 1111 1111", "4111111111111111", "3782 822463 10005"],
    "iban": ["BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
    "ssn": ["123-45-6789"],
    "phone": ["+49 30 1234567", "+1 (545) 555-9193", "555-123-4567", "+44 20 7946 0958", "+1 555 123 4567", "+91 98765 43210"],
    "ip": ["192.168.0.1", "10.0.0.1"],
    "date": ["2024-01-05", "5.1.2024", "01/05/2024"],
    "email": ["jo.doe7@mail3.example.com", "JOHN@x.org"],
}
PSEUDONYM = lambda text: pseudonyms.pseudonymize_text(text, b"k")


@pytest.mark.parametrize("mark", [" ", ", ", "\n"])
def test_values_next_to_any_other(mark):
    values = [(k, v) for k, vs in VALUES.items() for v in vs]
    words = ["BIC", "ID12", "1999", "42", "12345", "A", "XYZ1", "SWIFT", "and"]
    for kind, value in values:
        assert PSEUDONYM(value) != value
        for word in words:
            assert PSEUDONYM(value + mark + word) == PSEUDONYM(value) + mark + word
            counts = {}
            text = pseudonyms.pseudonymize_text(word + mark + value, b"k", counts)
            assert text == word + mark + PSEUDONYM(value) and counts == {kind: 1}
        for other, more in values:
            counts = {}
            text = pseudonyms.pseudonymize_text(value + mark + more, b"k", counts)
            assert text == PSEUDONYM(value) + mark + PSEUDONYM(more), (value, more)
            assert counts == Counter([kind, other])


def test_values_inside_what_is_not_valid():
    card = PSEUDONYM("4111 1111 1111 1111")
    assert PSEUDONYM("ID12 4111 1111 1111 1111") == f"ID12 {card}"
    assert PSEUDONYM("1234 4111 1111 1111 1111") == f"1234 {card}"
    assert PSEUDONYM("BE68 5390 0754 7035 BIC") == "BE68 5390 0754 7035 BIC"
    assert PSEUDONYM("+49 30 1234567 2024-01-05 1999") == f"{PSEUDONYM('+49 30 1234567')} {PSEUDONYM('2024-01-05')} 1999"
    whole = PSEUDONYM("+49 30 123-45-67-89")
    assert len(re.sub(r"[^0-9]", "", whole)) == 13 and whole[-3] == "-" and whole[-2:] != "89"


def test_pseudonyms_keep_format_and_links(awkward, no_rows, make_docs):
    out = {r.doc_id: r for r in pseudonyms.pseudonymize(awkward, KEY).collect()}
    assert out[1].text is None and out[2].text == "" and out[1].n_replaced == 0
    assert out[7].text.startswith("the quick") and out[10].text == "漢字 é 😀 ñandú x y"
    new = out[14].text
    assert "4532015112830366" not in new and "10.0.0.1" not in new and "2020-02-29" not in new
    assert "4532015112830367" in new and "2021-02-29" in new
    card = re.search(r"card (\d{16}) ", new)[1]
    assert pseudonyms.luhn(card[:-1]) == int(card[-1])
    assert (out[14].n_card, out[14].n_ip, out[14].n_date, out[14].n_replaced) == (1, 1, 1, 3)
    assert pseudonyms.pseudonymize(no_rows, KEY).count() == 0
    values = ["4532 0151 1283 0366", "+1 (017) 555-7713", "GB82 WEST 1234 5698 7654 32", "078-05-1120", "ab.9@x.org", "31/12/1999"]
    rows = [(i, f"see {v}, twice: {v}.", None, None, 1) for i, v in enumerate(values)]
    for (_, before, *_), r in zip(rows, sorted(pseudonyms.pseudonymize(make_docs(rows), KEY).collect())):
        shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", t)))
        assert shape(r.text) == shape(before) and r.text != before
        first, second = re.fullmatch(r"see (.*), twice: (.*)\.", r.text).groups()
        assert first == second and r.n_replaced == 2
    other = pseudonyms.pseudonymize(make_docs(rows), "other key").collect()
    assert {r.text for r in other}.isdisjoint({r.text for r in pseudonyms.pseudonymize(make_docs(rows), KEY).collect()})


# ---- quality


def expected_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), len(lines), len(text),
    )


def test_statistics_match_brute_force(awkward, no_rows, make_docs):
    plain = awkward.toDF(*[f"c{i}" for i in range(len(awkward.columns))]).selectExpr("c0 doc_id", "c1 text").collect()
    want = sorted(((r.doc_id, *expected_counts(r.text)) for r in plain), key=repr)
    assert bag(text_statistics(awkward).select("doc_id", *COUNTS)) == want
    assert text_statistics(no_rows).count() == 0
    long = " ".join(f"w{i % 700}" for i in range(300_000)) + "\nx\n\nx"
    got = text_statistics(make_docs([(1, long, None, None, 1)])).collect()[0]
    assert tuple(got)[1:] == expected_counts(long)


@has_tables
def test_statistics_of_the_tables(spark):
    docs = {d["doc_id"]: d["text"] for d in table("documents")}
    labels = {r["doc_id"]: r["quality"] for r in table("labels")}
    found = QUERIES["op8_quality_rules"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    for r in found:
        n = expected_counts(docs[r.doc_id])
        assert tuple(r)[1:6] == n[:5]
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
    clean = [r for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in found if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_decision_list_finds_planted_rules(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    label = np.where((data["a"] > 0.8) | ((data["b"] > 0.7) & (data["c"] <= 0.3)), 0, 1)
    rules = learn_decision_list(data, label)
    frame = spark.createDataFrame([tuple(map(float, x)) for x in zip(*data.values())], "a double, b double, c double")
    column = decision_column(rules, 1, {k: F.col(k) for k in data})
    got = np.array([r[0] for r in frame.select(column).collect()])
    assert (got == label).mean() > 0.97
    assert learn_decision_list({"a": np.zeros(0)}, np.zeros(0, int)) == []
    assert learn_decision_list({"a": np.ones(9)}, np.zeros(9, int)) == []


def test_quality_without_labels(awkward, no_rows, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = judge_quality(awkward, none).collect()
    assert all(r.kept == (not r.base_failed) for r in rows) and len(rows) == awkward.count()
    assert judge_quality(no_rows, none).count() == 0


# ---- tokens


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary(read_ranks(RANKS)), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_matches_merging(reference, encoder, text):
    text = text.encode("utf-8", "replace").decode()
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_encoding_of_long_pieces_is_exact(reference, encoder):
    for text in ("a" * 5000 + " " * 3000 + "é" * 500, "ab" * 4000 + "\n" * 900, "the" * 3000):
        assert encoder.encode(text) == reference.encode_ordinary(text)


def test_digests_of_awkward_rows(awkward, no_rows, reference, make_docs):
    def digests(df):
        return digest_documents(df, RANKS, public_tokenizers.PATTERN)

    def expected(i, text):
        ids = reference.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        return i, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    plain = awkward.toDF(*[f"c{i}" for i in range(len(awkward.columns))]).selectExpr("c0 doc_id", "c1 text").collect()
    assert bag(digests(awkward)) == sorted((expected(r.doc_id, r.text) for r in plain), key=repr)
    assert digests(no_rows).count() == 0
    decoded = decode_documents(encode_documents(awkward, RANKS, public_tokenizers.PATTERN), RANKS)
    want = sorted(((r.doc_id, reference.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in plain), key=repr)
    assert sorted(((r.doc_id, r.ids, bytes(r.data)) for r in decoded.collect()), key=repr) == want
    long = "Long texts, 1 by 1! " * 120_000
    assert bag(digests(make_docs([(1, long, None, None, 1), (2, "x", None, None, 1)]))) == [expected(1, long), expected(2, "x")]


@has_tables
def test_digests_of_the_tables(spark, reference):
    want = {d["doc_id"]: reference.encode_ordinary(d["text"]) for d in table("documents")}
    got = QUERIES["op9_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()


# ---- whole licence texts, long runs and repeated ids


def filled(template, rng, options):
    """A template as a text: optional regions in or out, replaceable ones filled."""
    while "<<beginOptional>>" in template:
        template = re.sub(
            r"<<beginOptional>>((?:(?!<<beginOptional>>|<<endOptional>>).)*)<<endOptional>>",
            lambda m: m[1] if options and rng.random() < 0.7 else " ",
            template, count=1, flags=re.DOTALL,
        )
    return re.sub(r"<<var;(\d+)>>", lambda m: " ".join(rng.choice(["Acme", "2024", "foo"]) for _ in range(rng.randint(1, int(m[1])))), template)


@pytest.mark.parametrize("number", range(len(licenses.TEXTS)))
def test_whole_licences_and_altered_copies(number):
    rng = random.Random(number)
    label, template = licenses.TEXTS[number]
    scanner = licenses.Scanner(licenses.PHRASES, [(label, licenses.unpunctuated(template))])
    for options in (False, True, True, True):
        text = filled(template, rng, options)
        n, _, found = scanner.scan(f"intro words {text} outro words".encode())
        longest = max(found, key=lambda m: m.end - m.start)
        assert longest.label == label and longest.exact / (longest.end - longest.start) > 0.6
        assert n - 2 <= longest.end <= n  # a replaceable end takes what follows
        words = lambda t: Counter(re.findall("[a-z]{9,}", t.lower()))
        mandatory = words(filled(template, rng, False))
        fixed = [m for m in re.finditer(r"[A-Za-z]{9,}", text) if words(text)[m[0].lower()] == mandatory[m[0].lower()]]
        for m in rng.sample(fixed, 5):  # one mandatory word reads otherwise
            altered = text[: m.start()] + "xylophone" + text[m.end() :]
            spans = scanner.scan(altered.encode())[2]
            assert all(s.end - s.start < longest.end - longest.start - 2 for s in spans)


def test_long_words_are_scored_as_short_ones_are(monkeypatch):
    lattice = lattice_lm.Lattice(lattice_lm.read_pieces(PIECES))
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeghé漢字😀xyz01") for _ in range(rng.randrange(70, 300))).encode() for _ in range(20)]
    long = lattice.log_probabilities(words)
    monkeypatch.setattr(lattice_lm, "LONG_WORD", 10**9)
    assert np.allclose(long, lattice.log_probabilities(words), rtol=1e-12)


def test_one_word_of_many_bytes_is_scored_in_seconds():
    lattice = lattice_lm.Lattice(lattice_lm.read_pieces(PIECES))
    begun = time.perf_counter()
    lattice.log_probabilities([b"abcdefgh" * 25_000, "漢字".encode() * 30_000])
    assert time.perf_counter() - begun < 10


def test_long_mail_names_are_permuted_whole():
    rng, kept = random.Random(4), 0
    for _ in range(100):
        name = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(64))
        out = pseudonyms.pseudonymize_text(f"{name}@x.org", b"key").partition("@")[0]
        kept += sum(a == b for a, b in zip(name, out))
        value = rng.randrange(26**64)
        assert pseudonyms.unpermute(pseudonyms.permute(value, 26**64, b"k", "t"), 26**64, b"k", "t") == value
    assert kept < 100 * 64 / 26 * 1.5
    same = pseudonyms.pseudonymize_text("..bob@x.org bob@x.org, (bob@x.org) -bob@x.org", b"key")
    assert len(set(re.findall(r"[a-z]{3}@x.org", same))) == 1 and same.startswith("..")


@pytest.mark.parametrize("piece", ["abcABC012xyz", "a.b-c_", "a1", "1.", "+12 ", "x@a.1."])
def test_scans_of_long_runs_are_linear(piece):
    text = piece * (1_000_000 // len(piece)) + "1"
    begun = time.perf_counter()
    pseudonyms.pseudonymize_text(text, b"key")
    assert time.perf_counter() - begun < 60


def test_rows_that_share_a_labelled_id_teach_once(spark, make_docs):
    rows = [(i % 40, "word " * (5 + i % 50), "en", "a", 1) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    collected = []
    learn = decision_list.learn_decision_list
    try:
        decision_list.learn_decision_list = lambda data, label: collected.append(len(label)) or learn(data, label)
        assert decision_list.judge_quality(make_docs(rows), labels).count() == 400
        assert decision_list.judge_quality(make_docs(rows), labels, max_rows=7).count() == 400
    finally:
        decision_list.learn_decision_list = learn
    assert collected == [40, 7]
