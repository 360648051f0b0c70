"""Operators on documents: awkward rows, empty tables, and plain versions of each."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from bazaargraph.llm import language, license_scan, mixing, ngram_join, pieces, quality, toxicity
from tests.llm.data import awkward, frame, words

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces.load(pieces.MODEL)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# op1


def test_encoding_equals_the_unigram_library(vocabulary):
    proto = model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = float(vocabulary.scores[i])
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encode = pieces.Encoder(vocabulary)
    for text in ["The quick brown fox", "  two   blanks ", "été à la plage", words(3, 200)]:
        assert encode([text])[0].tolist() == library.encode(text)


def test_segmentation_is_best_of_all(vocabulary):
    by_text = {t.encode(): s for t, s in zip(vocabulary.texts, vocabulary.scores, strict=True) if t}
    encode = pieces.Encoder(vocabulary)
    for word in ["hello", "unbelievable", "zzzxqj", "aaaaaaa"]:
        unit = f"▁{word}".encode()
        best = [0.0] + [-math.inf] * len(unit)
        for end in range(1, len(unit) + 1):
            best[end] = max(
                best[start] + by_text.get(unit[start:end], -math.inf) for start in range(end)
            )
        ids = encode([word])[0]
        assert sum(vocabulary.scores[ids]) == best[-1]


def test_round_trip_and_awkward_rows(spark):
    coded = pieces.encode_texts(frame(spark)).cache()
    texts = Counter(r[:2] for r in awkward())
    assert Counter(rows_of(pieces.decode_ids(coded))) == texts
    for doc_id, ids, restored in rows_of(coded):
        assert (ids is None) == (restored is None) and restored is not False
    assert pieces.encode_texts(frame(spark, [])).count() == 0


# op2


def test_mix_meets_targets(spark):
    docs = [(i, words(i, 3 + i * 7 % 90), None, f"s{i % 4}", None, 0.0, "") for i in range(400)]
    docs += [(400 + i, words(9, 20), None, None, None, 0.0, "") for i in range(30)]
    mixed = mixing.mix_sources(frame(spark, docs)).toPandas()
    sizes = Counter()
    for row in docs:
        sizes[row[3]] += len(SPACE_WORD.findall(row[1]))
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    targets: dict = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(targets.values())
        share = left / sum(weight[s] for s in order if s not in targets)
        full = [s for s in order if s not in targets and share * weight[s] >= 2 * sizes[s]]
        if not full:
            break
        targets |= {s: 2 * sizes[s] for s in full}
    targets |= {s: share * weight[s] for s in order if s not in targets}
    assert (mixed["taken"] <= 2 * mixed["size"]).all() and (mixed["copies"] <= 2).all()
    for source, part in mixed.groupby(mixed["source"].fillna("-")):
        key = None if source == "-" else source
        assert part["target"].iloc[0] == pytest.approx(targets[key])
        assert abs(part["taken"].sum() - targets[key]) <= 5
    again = mixing.mix_sources(frame(spark, docs[::-1])).toPandas()
    assert dict(zip(mixed["doc_id"], mixed["copies"])) == dict(zip(again["doc_id"], again["copies"]))


def test_mix_of_far_apart_sizes_and_an_empty_source(spark):
    # A Newton step puts all of s0 at the cap, where the slope is 0; s2 has no words.
    sizes = [10] * 1000 + [1000] * 10 + [20] * 689 + [0] * 5
    source = ["s0"] * 1010 + ["s1"] * 689 + ["s2"] * 5
    docs = [
        (i, "w " * n, None, s, None, 0.0, "") for i, (n, s) in enumerate(zip(sizes, source))
    ]
    mixed = mixing.mix_sources(frame(spark, docs)).toPandas()
    assert mixed["copies"].between(0, 2).all() and len(mixed) == len(docs)
    targets = {"s0": 0.75 * 1.5 * 33_780, "s1": 0.25 * 1.5 * 33_780, "s2": 0.0}
    for name, part in mixed.groupby("source"):
        assert part["target"].iloc[0] == pytest.approx(targets[name])
        assert 0 <= targets[name] - part["taken"].sum() < 20
    # The tilt favours long documents: they are all at the cap, the short ones just below it.
    s0 = mixed[mixed["source"] == "s0"]
    assert (s0.loc[s0["size"] == 1000, "copies"] == 2).all()
    assert s0.loc[s0["size"] == 10, "copies"].sum() == 1800


def test_mix_of_awkward_rows(spark):
    mixed = rows_of(mixing.mix_sources(frame(spark)).select("doc_id", "size"))
    expected = [(r[0], len(SPACE_WORD.findall(r[1] or ""))) for r in awkward()]
    assert Counter(mixed) == Counter(expected)
    assert mixing.mix_sources(frame(spark, [])).count() == 0


# op3, op4, op6


def labelled(spark, name, bad):
    docs = [
        (i, words(i, 80) + (bad if i % 4 == 0 else "") + words(i + 7000, 40), "en" if i % 2 else "fr",
         None, None, 0.0, "")
        for i in range(600)
    ]
    labels = spark.createDataFrame(
        [(i, int((i % 4 == 0) == (name == "toxic"))) for i in range(600)] + [(None, 1), (3, None)],
        f"doc_id long, {name} int",
    )
    return frame(spark, docs), labels


def test_toxicity_finds_spans_and_leaves_clean_texts(spark):
    docs, labels = labelled(spark, "toxic", " rotten zzscumzz ")
    field = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, field).where("held_out").collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in scored)
    text = "wir gehen; ROTTEN zzscum"
    score, spans = toxicity.score_texts(
        field, [text.encode()], toxicity.WordHasher(toxicity.SEPARATORS, toxicity.PREFIXES)
    )
    assert score[0] > 0.5 and text[spans[0][0]["start"] : spans[0][0]["end"]] == "ROTTEN zzscum"
    assert len(rows_of(toxicity.score_toxicity(frame(spark), field))) == len(awkward())
    assert toxicity.train(frame(spark, []), labels) is None
    assert toxicity.score_toxicity(frame(spark, []), None).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}


def test_toxic_words_of_a_small_language_are_learnt():
    texts, labels = [], []
    for i in range(1200):
        bad = "" if i % 4 else " rotten " if i % 120 else " réeuxlich "  # 290 and 10 documents
        texts.append(f"{words(i, 40)}{bad}{words(i + 7000, 20)}".encode())
        labels.append(int(i % 4 == 0))
    field = toxicity.fit(texts, np.array(labels))
    text = f"{words(1, 30)} réeuxlich {words(2, 30)}".encode()
    score, spans = toxicity.score_texts(
        field, [text, words(3, 60).encode()],
        toxicity.WordHasher(toxicity.SEPARATORS, toxicity.PREFIXES),
    )
    assert [text[s["start"] : s["end"]].decode() for s in spans[0]] == ["réeuxlich"]
    assert score[0] >= toxicity.THRESHOLD > score[1] and spans[1] == []


def test_chain_ratios_equal_a_plain_loop():
    rng = np.random.default_rng(1)
    a, b, c, d = rng.uniform(0.1, 3, (4, 5000))
    r, plain = 0.0, []
    for t in range(5000):
        r = (a[t] * r + b[t]) / (c[t] * r + d[t])
        plain.append(r)
    np.testing.assert_allclose(toxicity.ratios(a, b, c, d), plain, rtol=1e-9)


def test_marginals_equal_all_labellings():
    field = toxicity.Field(
        np.zeros(0, np.uint64), np.array([0.7, -1.2, 0.0]), -0.3, np.array([[0.4, -0.5], [0.1, 0.9]]),
        0.2, np.zeros(3),
    )
    index = np.array([[0], [1], [1], [0], [1]])
    emission = field.emission[index[:, 0]] + field.bias
    total, on = 0.0, np.zeros(5)
    for code in range(32):
        y = [code >> t & 1 for t in range(5)]
        w = field.start * y[0] + sum(emission * y)
        w = math.exp(w + sum(field.transition[i, j] for i, j in zip(y, y[1:])))
        total += w
        on += w * np.array(y)
    first = np.array([True, False, False, False, False])
    np.testing.assert_allclose(field.marginals(index, first), on / total)


def test_code_lengths_equal_a_plain_model():
    texts = {"a": [b"abracadabra abba", b"cab"], "b": [b"hello yellow", b"lol"]}
    model = language.fit(texts)
    seen = Counter(b for own in texts.values() for t in own for b in language.PAD + t)

    def cost(name, context, byte):
        for order in range(3, -1, -1):
            tail = context[3 - order :]
            after = Counter(
                padded[k]
                for t in texts[name]
                for padded in [language.PAD + t]
                for k in range(3, len(padded))
                if padded[k - order : k] == tail
            )
            if byte in after:
                return -math.log2(after[byte] / (sum(after.values()) + len(after)))
            if after:
                extra = -math.log2(len(after) / (sum(after.values()) + len(after)))
                return extra + (shorter(name, context, byte, order))
        return math.log2(language.SYMBOLS)

    def shorter(name, context, byte, order):
        for lower in range(order - 1, -1, -1):
            tail = context[3 - lower :]
            after = Counter(
                padded[k]
                for t in texts[name]
                for padded in [language.PAD + t]
                for k in range(3, len(padded))
                if padded[k - lower : k] == tail
            )
            if byte in after:
                return -math.log2(after[byte] / (sum(after.values()) + len(after)))
            if after:
                return -math.log2(len(after) / (sum(after.values()) + len(after))) + shorter(
                    name, context, byte, lower
                )
        return math.log2(language.SYMBOLS)

    for text in [b"abba", b"hello cab", b"", b"lolo" * 9]:
        padded = language.PAD + text
        assert all(b in seen for b in padded)
        for k, name in enumerate(model.names):
            plain = sum(cost(name, padded[i - 3 : i], padded[i]) for i in range(3, len(padded)))
            assert model.code_lengths([b"lol", text])[1, k] == pytest.approx(plain, abs=0.01 * len(padded))
    long = b"abracadabra " * 100_000
    assert model.code_lengths([long])[0].argmin() == 0


def test_languages_of_awkward_rows(spark):
    docs = [
        (i, (words(i, 20) if i % 2 else words(i, 20).translate(str.maketrans("abcd", "wxyz"))),
         "de" if i % 2 else "es", None, None, 0.0, "")
        for i in range(200)
    ]
    model = language.train(frame(spark, docs))
    found = language.predict_languages(frame(spark, docs), model).where("held_out").collect()
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "es") for r in found)
    rows = language.predict_languages(frame(spark), model).collect()
    assert len(rows) == len(awkward())
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {2, 3, 4, 12, None}
    assert language.train(frame(spark, [])) is None
    assert language.predict_languages(frame(spark, []), None).count() == 0
    assert language.identified_documents(frame(spark), model).columns == frame(spark).columns


def test_quality_of_awkward_rows(spark):
    docs, labels = labelled(spark, "quality", " BUY!! NOW!! " * 8)
    net = quality.train(docs, labels)
    scored = quality.score_quality(docs, net).where("held_out").collect()
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in scored)
    assert len(rows_of(quality.score_quality(frame(spark), net))) == len(awkward())
    assert quality.good_documents(docs, net).columns == docs.columns
    assert quality.train(frame(spark, []), labels) is None
    assert quality.score_quality(frame(spark, []), net).count() == 0


def test_blocks_of_a_long_text_change_no_score():
    net = quality.Network(
        np.random.default_rng(1).standard_normal((quality.WIDTH * quality.CHANNELS, 4)).astype(np.float32),
        np.zeros(4, np.float32), np.ones(8) * 0.1, 0.0,
    )
    texts = [words(4, 120_000).encode(), b"short", None]
    raw, chunks = quality.padded(texts)
    whole = net.combine(net.chunks(raw), chunks)[1]
    np.testing.assert_allclose(net.scores(texts), whole, rtol=1e-6)


# op5


def plain_components(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            w = SPACE_WORD.findall((text or "").translate(LOWER))
            n = min(5, len(w))
            sets[doc_id] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    label = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if union and 100 * both >= 80 * union and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {d: (len(sets[d]), label[d]) for d in sets}


def edited(seed, base, changes):
    rng = np.random.default_rng(seed)
    out = base.split()
    for k in rng.choice(len(out), changes, replace=False):
        out[k] = f"w{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("group", [2048, 4])
def test_links_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    base, passage = words(1, 150), words(2, 60)
    rows = awkward()
    rows += [(100 + i, edited(i, base, i % 8), None, None, None, 0.0, "") for i in range(60)]
    rows += [(200 + i, f"{passage} {words(900 + i, 40)}", None, None, None, 0.0, "") for i in range(40)]
    rows += [(300 + i, words(i, 3 + i % 9), None, None, None, 0.0, "") for i in range(40)]
    found = ngram_join.jaccard_components(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    expected = plain_components(rows)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None
        else:
            assert (row.n_shingles, row.component_id) == expected[row.doc_id]


def test_links_when_tokens_are_counted(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SAMPLE", 20)
    base = words(1, 150)
    rows = [(i, edited(i, base, i % 9), None, None, None, 0.0, "") for i in range(80)]
    found = ngram_join.jaccard_components(frame(spark, rows)).collect()
    expected = plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_no_documents_to_join(spark):
    assert ngram_join.jaccard_components(frame(spark, [])).count() == 0


# op9


def test_licenses_equal_a_plain_scan(spark):
    rows = awkward() + [
        (50, "CC BY cc-by CC  BY. All rights\nreserved", None, None, None, 0.0, ""),
        (51, "this work is licensed under a gnu general public license version 3", None, None, None, 0.0, ""),
        (52, "all rights all rights reserved general public", None, None, None, 0.0, ""),
    ]
    found = license_scan.scan_licenses(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for doc_id, text, *_ in rows:
        if doc_id is None:
            continue
        w = re.findall(license_scan.WORD, (text or "").translate(LOWER))
        hits = [
            (i, label)
            for phrase, label in license_scan.BASE
            for p in [phrase.split()]
            for i in range(len(w))
            if w[i : i + len(p)] == p
        ]
        row = by_id[doc_id]
        places = [i for i, _ in hits]
        assert (row.n_words, row.n_base) == (len(w), len(hits))
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted({k for _, k in hits}))
    assert "gpl-notice" in by_id[51].labels.split(",")
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0
