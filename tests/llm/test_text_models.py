"""Language, quality, fingerprints and decontamination."""

from __future__ import annotations

import hashlib
import random
import re
import resource

import numpy as np
import pytest
from tables_of_texts import edge_texts, prose, rows

from quillstat.llm import decontamination, langid, lempelziv, quality
from quillstat.llm.arrays import hash_words, split_words

SYLLABLES = {"xx": "ka lo mi tu re", "yy": "sch ung heit ber", "zz": "eau oux é ille"}


def babble(lang, seed, words=40):
    rng = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))


# Arrays


def test_words_of_bytes():
    texts = [t or "" for _, t in edge_texts()]
    laid = split_words([t.encode() for t in texts])
    for k, text in enumerate(texts):
        want = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        at = range(laid.first[k], laid.first[k + 1])
        spans = [(laid.start[i], laid.start[i] + laid.length[i]) for i in at]
        assert [laid.buf[a:b].tobytes() for a, b in spans] == want


def test_equal_words_have_equal_hashes():
    words = [f"{'w' * (k % 40)}{k % 300}" for k in range(2000)]
    found = hash_words(split_words([" ".join(words[:700]).encode(), "\n".join(words[700:]).encode()]))
    by_word = {}
    for word, h in zip(words, found.tolist(), strict=True):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


# Language


@pytest.fixture
def spoken(spark):
    langs = list(SYLLABLES)
    data = [(k, babble(langs[k % 3], k), langs[k % 3] if k % 7 else None) for k in range(150)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_language(spoken):
    truth = {k: list(SYLLABLES)[k % 3] for k in range(150)}
    got = langid.predict(spoken).collect()
    assert len(got) == 150
    held = [r for r in got if r.held_out]
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_edges(edges):
    got = langid.predict(edges).collect()
    assert len(got) == len(edge_texts())
    for r in got:
        texts = [t for i, t in edge_texts() if i == r.doc_id]
        lettered = [any(c.isalpha() for c in t or "") for t in texts]
        assert (r.lang_pred == "und") in {not x for x in lettered}
    kept = langid.keep_known(edges)
    assert kept.columns == edges.columns
    assert all(any(c.isalpha() for c in r.text or "") for r in kept.collect())


def test_many_short_texts_in_large_alphabets():
    """Memory follows the texts, not the product of texts and n-grams."""
    rng = random.Random(3)
    chinese = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(100)) for _ in range(10_000)]
    mixed = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz/+7") for _ in range(100)) for _ in range(10_000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for texts in (chinese, mixed, ["a"] * 50_000):
        for lot in langid._lots(texts):
            sums, known = langid.profiles(lot)
            assert len(sums) == len(lot) <= langid.LOT_TEXTS and known.min() > 0
    after = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert after - before < 400_000  # kilobytes


@pytest.mark.parametrize("dense", [0, 10**9])
def test_both_ways_of_adding_up_agree(monkeypatch, dense):
    texts = ["", "a", *[prose(k, 60) for k in range(5)], "日本語のテキスト" * 9]
    want, _ = langid.profiles(texts)
    monkeypatch.setattr(langid, "DENSE", dense)
    monkeypatch.setattr(langid, "BLOCK", 300)
    monkeypatch.setattr(langid, "BLOCK_CELLS", 2000)
    monkeypatch.setattr(langid, "PAIRS", 7)
    got, _ = langid.profiles(texts)
    assert (got == want).all()


def test_nothing_learned(table, empty):
    assert langid.predict(empty).count() == 0
    unlabelled = table([(1, "some text"), (2, None)]).drop("lang").selectExpr("*", "string(null) lang")
    assert {r.lang_pred for r in langid.predict(unlabelled).collect()} == {"und"}


def test_profile_is_the_bundle_of_bound_letters():
    """Against the definition: rotate, multiply, add."""
    text = "ab é"
    vector = {c: langid._letter_vector(ord(c), 64).astype(int) for c in " abé"}
    want = np.zeros(64)
    for gram in (" ab", "ab ", "b é", " é "):
        bound = np.ones(64, int)
        for place, c in enumerate(gram):
            bound *= np.roll(vector[c], 2 - place)
        want += bound
    got, letters = langid.profiles(["Ab \n é!", text, ""], 64)
    assert got[0].tolist() == want.tolist() == got[1].tolist()
    assert letters.tolist() == [3, 3, 0] and not got[2].any()


# Quality


def test_quality(spark):
    good = [(k, babble("xx", k, 60 + k % 90)) for k in range(120)]
    bad = [(1000 + k, babble("xx", k, 80).upper().replace(" ", "!! ")) for k in range(40)]
    bad += [(2000 + k, " ".join(w for w in babble("xx", k, 30).split() for _ in range(5))) for k in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(77777, 1), (None, 1), (3, None)],
        "doc_id long, quality int",
    )
    got = quality.classify(docs, labels).collect()
    assert len(got) == 200
    held = [r for r in got if r.held_out]
    right = [r.predicted == int(r.doc_id < 1000) for r in held]
    assert held and sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    again = {r.doc_id: r.score for r in quality.classify(docs.repartition(5), labels).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_quality_of_edges(edges, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 130)], "doc_id long, quality int")
    got = quality.classify(edges, labels).collect()
    assert len(got) == len(edge_texts()) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(empty, labels).count() == 0
    unknown = quality.classify(edges, labels.limit(0)).collect()
    assert {r.score for r in unknown} == {0.5}


def test_gradients():
    """Every slope against a small step of its weight."""
    rng = np.random.default_rng(4)
    per_text = np.array([3, 1, 4])
    x = rng.standard_normal((8, quality.FEATURES))
    bags, label = quality.Bags(x, per_text), np.array([1.0, 0.0, 1.0])
    model = quality.Attention(x.mean(axis=0), x.std(axis=0))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        p = model.forward(bags)["score"]
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    slopes = model.gradients(bags, label)
    for name, weight in model.weights.items():
        place = tuple(rng.integers(0, n) for n in weight.shape)
        weight[place] += 1e-5
        up = loss()
        weight[place] -= 2e-5
        down = loss()
        weight[place] += 1e-5
        assert slopes[name][place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


# Fingerprints


def test_phrases():
    """Each phrase is the shortest new one."""
    symbols = [1, 2, 1, 2, 3, 1, 2, 3, 1]
    want, phrase = set(), ()
    for s in symbols:
        phrase += (s,)
        if phrase not in want:
            want.add(phrase)
            phrase = ()
    assert want == {(1,), (2,), (1, 2), (3,), (1, 2, 3)}
    assert len(lempelziv.phrases(symbols)) == len(want)


@pytest.mark.parametrize("part_bytes", [16_000_000, 3_000])
def test_compare(edges, monkeypatch, part_bytes):
    monkeypatch.setattr(lempelziv, "PART_BYTES", part_bytes)
    pairs = sorted(edge_texts(), key=lambda p: (p[0] is None, -(p[0] or 0), (p[1] or "").encode()))
    texts = [t or "" for _, t in pairs]
    want = []
    for k, (i, _) in enumerate(pairs):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        prints = lempelziv.fingerprints([t.encode() for t in (text, changed, after)])
        near = (prints[0] == prints[1]).mean(), (prints[0] == prints[2]).mean()
        shown = [p.astype(">u2").tobytes().hex() for p in prints]
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), *shown[:2], *near))
    got = rows(
        lempelziv.compare(edges), "doc_id", "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )
    assert got == sorted(((*w[:5], float(w[5]), float(w[6])) for w in want), key=repr)


def test_likeness_follows_the_text():
    base = prose(1, 400)
    words = base.split()
    words[200] = "other"
    texts = [base, " ".join(words), base[: len(base) // 2] + prose(2, 200), prose(3, 400)]
    f = lempelziv.fingerprints([t.encode() for t in texts])
    near = [(f[0] == f[k]).mean() for k in range(1, 4)]
    assert near[0] > 0.75 > near[1] > near[2]


def test_one_and_no_documents(table, empty):
    assert lempelziv.compare(empty).count() == 0
    (row,) = lempelziv.compare(table([(4, "a single text here")])).collect()
    assert row.near_next == 1


# Decontamination


@pytest.fixture
def items(spark):
    data = [(k, prose(700 + k, 15 + 3 * k, vocabulary=4000)) for k in range(8)]
    data += [(20, None), (21, ""), (22, "two words"), (23, data[0][1]), (None, data[1][1])]
    return spark.createDataFrame(data, "item_id long, text string")


def test_align():
    item = np.arange(10, dtype=np.uint64)
    passage = np.array([50, 51, 0, 1, 2, 99, 4, 5, 6, 7, 60, 8, 9, 52], np.uint64)
    # 9 equal words, one unequal, one skipped.
    assert decontamination.align(item, passage) == (7, 13)
    assert decontamination.align(item, np.array([70, 71], np.uint64)) == (0, 0)


def brute_score(item, text):
    """Smith-Waterman over the whole text, cell by cell."""

    def split(t):
        return re.findall(r"[^\W_]+|[^\x00-\x7f]+", t.lower())

    a, b = split(item), split(text)
    row, best = [0] * (len(b) + 1), 0
    for x in a:
        new = [0]
        for k, y in enumerate(b, 1):
            new.append(max(0, row[k - 1] + (1 if x == y else -1), row[k] - 1, new[-1] - 1))
        row, best = new, max(best, *new)
    return best / len(a)


def test_leaks(table, items, monkeypatch):
    known = {r.item_id: r.text for r in items.collect() if r.item_id is not None}
    rng = random.Random(8)
    pairs, k = [], 0
    for i in range(8):
        words = known[i].split()
        for edits in (0, 1, len(words) // 8):
            own = list(words)
            for _ in range(edits):
                own[rng.randrange(len(own))] = "changed"
            passage = " ".join(own).upper().replace(" ", ", ")
            pairs.append((k, f"{prose(800 + k, 30)} {passage}. {prose(900 + k, 30)}"))
            k += 1
    clean = [(1000 + j, prose(1100 + j, 80, vocabulary=4000)) for j in range(30)]
    clean += [(2000, None), (2001, ""), (2002, "two words")]
    docs = table(pairs + clean)
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.find(docs, items).collect()}
    want = {
        (d, i): brute_score(t, text)
        for d, text in pairs + clean
        for i, t in known.items()
        if text and t
    }
    short = {i for i, t in known.items() if t and len(t.split()) < 3}
    want = {p: s for p, s in want.items() if s >= (1 if p[1] in short else 0.5)}
    assert {p: s for p, s in got.items() if p[1] is not None} == pytest.approx(want)
    # An item of two words is found where it stands whole.
    assert {d for d, _ in want} == {d for d, _ in pairs} | {2002}
    kept = decontamination.remove(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in clean} - {2002}
    # The same in blocks of items.
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    again = {(r.doc_id, r.item_id): r.score for r in decontamination.find(docs, items).collect()}
    assert again == got


def test_a_leak_in_most_documents(table, items):
    """An item whose n-grams are all frequent is still found everywhere."""
    item = [r.text for r in items.filter("item_id = 5").collect()][0]
    docs = table([(k, f"{prose(k, 20)} {item} {prose(k + 500, 20)}") for k in range(60)])
    found = decontamination.find(docs, items).filter("item_id = 5").collect()
    assert sorted(r.doc_id for r in found) == list(range(60))
    assert {r.score for r in found} == {1.0}


@pytest.mark.parametrize(("every", "phase"), [(5, 4), (6, 3)])
@pytest.mark.parametrize("verbatim", [0, 1, 60])
def test_copies_with_every_nth_word_replaced(table, items, every, phase, verbatim):
    """Whole n-grams that are more frequent than the broken ones are seeds too."""
    item = [r.text for r in items.filter("item_id = 7").collect()][0].split()
    own = " ".join(f"new{k}" if k % every == phase else w for k, w in enumerate(item))
    pairs = [(k, f"{prose(k, 20)} {own} {prose(50 + k, 20)}") for k in range(4)]
    pairs += [(1000 + k, f"{prose(k, 20)} {' '.join(item)}") for k in range(verbatim)]
    found = decontamination.find(table(pairs), items).filter("item_id = 7").collect()
    got = {r.doc_id: r.score for r in found}
    assert got == pytest.approx({d: brute_score(" ".join(item), t) for d, t in pairs})


@pytest.mark.parametrize("verbatim", [0, 60])
def test_copies_with_words_inserted(table, items, verbatim):
    """A word after every second one leaves no three words together, but pairs."""
    known = {r.item_id: r.text.split() for r in items.collect() if r.item_id in range(8)}
    pairs = []
    for i, words in known.items():
        own = " ".join(f"{w} new{k}" if k % 2 else w for k, w in enumerate(words))
        pairs.append((i, f"{prose(i, 20)} {own} {prose(50 + i, 20)}"))
        pairs += [(1000 + 100 * i + k, f"{prose(k, 20)} {' '.join(words)}") for k in range(verbatim)]
    texts = dict(pairs)
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.find(table(pairs), items).collect()}
    for i, words in known.items():
        score = brute_score(" ".join(words), texts[i])
        assert got.get((i, i)) == (pytest.approx(score) if score >= 0.5 else None)
    assert sum((i, i) in got for i in known) >= 4


def test_random_alignments_lose_nothing(table, spark):
    """Short items of few words, in which every pair of words is common somewhere."""
    rng = random.Random(5)

    def words(n):
        return " ".join(rng.choice("abcdefgh") for _ in range(n))

    known = {k: words(rng.randint(1, 9)) for k in range(25)}
    texts = {k: words(rng.randint(0, 25)) for k in range(40)}
    items = spark.createDataFrame(list(known.items()), "item_id long, text string")
    for least in (0.5, 0.8):
        found = decontamination.find(table(list(texts.items())), items, least).collect()
        want = {(d, i): brute_score(t, text) for d, text in texts.items() for i, t in known.items() if text}
        want = {p: s for p, s in want.items() if s >= (1 if len(known[p[1]].split()) < 3 else least)}
        assert {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)


def test_rare_pairs_are_the_seeds():
    items = decontamination.Items.of(["a b c d e f g h i j", "x", "y z"], 0.5)
    counts = np.arange(1, len(items.pairs.lookup.keys) + 1)
    seeds = items.seeds(counts)
    # Every copy holds four of nine pairs; of the eight rarest it holds three at least.
    assert len(counts) == 10 and list(seeds.need) == [3, 1, 1]
    chosen = np.bincount(seeds.pairs.item, minlength=3)
    assert list(chosen) == [8, 0, 1] and len(seeds.singles.lookup.keys) == 1
    # Pairs that occur nowhere are none; too few that occur mean that there is no copy.
    assert not len(items.seeds(counts * 0).pairs.lookup.keys)


def test_items_in_scripts_without_blanks(spark, table):
    """Copies of a Japanese, a Chinese and a Thai item are found inside running text."""
    texts = ["富士山の高さは何メートルですか", "世界上最长的河流是哪一条", "เมืองหลวงของประเทศไทยคืออะไร"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    edited = texts[0].replace("何", "幾")
    docs = table([(k, f"前{t}後 words") for k, t in enumerate(texts)] + [(3, edited), (4, "山川草木" * 5)])
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.find(docs, items).collect()}
    assert found == pytest.approx({(0, 0): 1, (1, 1): 1, (2, 2): 1, (3, 0): 1 - 2 / len(texts[0])})


def test_no_items_or_documents(edges, empty, items):
    assert decontamination.find(empty, items).count() == 0
    assert decontamination.find(edges, items.limit(0)).count() == 0
    assert decontamination.remove(edges, items.limit(0)).count() == edges.count()
