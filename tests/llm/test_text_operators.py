"""Brute force against the operators on whole texts: small, odd and repeated rows included."""

import hashlib
import json
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowferry.llm import bpe, bpe_lexicon, common, countmin, fingerprint, langid, ngram_join, packing, substring, token_counts
from rowferry.llm.queries import BYTE_BPE, WORD_BPE

BITS = 20  # small sketches: more false candidates, the same results
COLUMNS = "doc_id long, text string, lang string, block long, carry string, n long"  # names the operators use themselves
SPACE = re.compile("[\x20\x09-\x0d]+")


def made(seed=3, n=60):
    """Texts with exact and near copies, shared passages, odd white space, null and empty ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "ß", "x,y", " z"]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 4, 5, 34, 35, 36, 90, 200)))]
        if i % 5 == 0:
            words[10:10] = shared
        texts.append(" ".join(words))
    for i in range(0, n, 7):  # near copies
        words = texts[i].split(" ")
        if len(words) > 50:
            words[rng.randrange(len(words))] = "changed"
        texts.append("\t".join(words) + "\n")
    texts += [texts[3], texts[3], texts[12].upper(), None, "", " \n\t ", "a", "a", "w1 " * 300, " ".join(shared * 40)]
    return [(i, t, "en", 1, "c", 2) for i, t in enumerate(texts)] + [(None, texts[3], None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def test_merged_sketch_comes_in_lots(spark, monkeypatch):
    """The merged sketch is the same as that of one partial one, and is never collected whole."""
    keys = np.random.default_rng(3).integers(0, 2**63, 4000).astype(np.uint64)
    rows = spark.createDataFrame([(x.tobytes(),) for x in (keys[:2500], keys[2000:], keys[:300])], "keys binary").repartition(3)

    def partial(batches):
        for part in batches:
            for x in part.column(0).to_pylist():
                yield from countmin.partial(np.frombuffer(x, np.uint64), BITS)

    parts = rows.mapInArrow(partial, countmin.SCHEMA)

    def whole(self):
        raise AssertionError("collected whole")

    monkeypatch.setattr(type(parts), "collect", whole)
    sketch = countmin.merged(parts, BITS)
    want = np.zeros((2, 1 << BITS), bool)
    for row in range(2):
        slot, n = np.unique(countmin.slots(np.concatenate([keys[:2500], keys[2000:], keys[:300]]), row, BITS), return_counts=True)
        want[row, slot[n > 1].astype(np.int64)] = True
    assert (np.unpackbits(sketch, axis=1).astype(bool) == want).all()


def test_sketch_never_too_low():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    twice = keys[:700]
    parts = [b for lot in (keys[:3000], keys[3000:], twice) for b in countmin.partial(lot, BITS)]
    merged = {}
    for part in parts:
        for row, block, once, more in zip(*(c.to_pylist() for c in part.columns), strict=True):
            seen, many = merged.setdefault((row, block), [np.zeros(1 << countmin.BLOCK_BITS, bool), np.zeros(1 << countmin.BLOCK_BITS, bool)])
            a, b = countmin._flags(once), countmin._flags(more)
            many |= b | (seen & a)
            seen |= a | b
    sketch = np.zeros((2, (1 << BITS) // 8), np.uint8)
    step = (1 << countmin.BLOCK_BITS) // 8
    for (row, block), (_, many) in merged.items():
        sketch[row, block * step : block * step + step] = np.packbits(many)
    assert countmin.repeated(sketch, twice).all()
    assert countmin.repeated(sketch, keys[700:]).mean() < 0.05


@pytest.mark.parametrize("texts", [False, True])
def test_repeats_against_brute_force(spark, texts):
    rows = made()
    width = substring.WIDTH
    counts = {}
    for row in rows:
        w = words_of(row[1])
        for s in range(len(w) - width + 1):
            counts[tuple(w[s : s + width])] = counts.get(tuple(w[s : s + width]), 0) + 1
    want = []
    for row in rows:
        w = words_of(row[1])
        gone = set()
        for s in range(len(w) - width + 1):
            if counts[tuple(w[s : s + width])] > 1:
                gone.update(range(s, s + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        text = (kept if gone else row[1],) if texts else ()
        want.append((row[0], row[3], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), *text))
    out = substring.remove_repeats(frame(spark, rows), texts=texts, bits=BITS)
    have = [tuple(r) for r in out.select("carry.doc_id", "carry.block", *out.columns[1:]).collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert any(r[3] for r in want)


def test_runs_that_differ_in_order_have_other_hashes():
    rng = np.random.default_rng(3)
    for k in range(2, 41):
        h = rng.integers(0, 2**63, k).astype(np.uint64)
        for lane in (0, 1):
            seen = {int(common.span_hash(h, k, lane)[0])}
            for i in range(k):
                for j in range(i):
                    other = h.copy()
                    other[[i, j]] = h[[j, i]]
                    seen.add(int(common.span_hash(other, k, lane)[0]))
            assert len(seen) == 1 + k * (k - 1) // 2
        assert (common.span_hash(np.tile(h, 2), k)[[0, k]] == common.span_hash(h, k)).all()


def test_windows_in_another_order_are_no_repeats(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([words[1], words[0], *words[2:35]])]
    got = {r["carry"]["doc_id"]: r["n_removed"] for r in substring.remove_repeats(frame(spark, [(i, t, "en", 1, "c", 2) for i, t in enumerate(texts)]), bits=BITS).collect()}
    assert got == {0: 0, 1: 0}


def test_shingles_in_another_order_do_not_link(spark):
    words = [f"w{i}" for i in range(5)]
    texts = [" ".join(words), " ".join([words[3], *words[1:3], words[0], words[4]])]
    found = ngram_join.similar_documents(frame(spark, [(i, t, "en", 1, "c", 2) for i, t in enumerate(texts)]))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {0: 0, 1: 1}


def test_repeats_of_nothing(spark):
    assert substring.remove_repeats(frame(spark, made()).where("false"), bits=BITS).collect() == []


def components(links, nodes):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_similar(rows):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for row in rows:
        w = words_of((row[1] or "").encode().translate(lower).decode())
        sets[row[0]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = [i for i in sets if i is not None]
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    found = components(links, ids)
    return sorted(((i, len(s), found.get(i)) for i, s in sets.items()), key=str)


def test_similar_documents_against_brute_force(spark):
    rows = made()
    have = sorted((tuple(r) for r in ngram_join.similar_documents(frame(spark, rows), bits=BITS).collect()), key=str)
    assert have == brute_similar(rows)


def test_chains_of_near_copies(spark):
    """A hub that not all members link with: what hangs together through others must still be found."""
    rng = random.Random(5)
    base = [f"t{i}" for i in range(160)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice((1, 2, 3, 4, 6, 9))):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", 1, "c", 2))
    have = sorted((tuple(r) for r in ngram_join.similar_documents(frame(spark, rows), bits=BITS).collect()), key=str)
    assert have == brute_similar(rows)
    assert 1 < len({r[2] for r in have}) < 150


def near_copies(n, seed=11):
    """Copies of one text with up to a fourth of its words changed: many link with some copies and not with others."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice((1, 1, 2, 2, 3, 4, 5, 8))):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", 1, "c", 2))
    return rows


def test_compared_pairs_grow_with_the_copies_not_with_their_square(spark, monkeypatch):
    seen = []
    verified = ngram_join._verified

    def counted(pairs, sets, name):
        seen[-1] += pairs.count()
        return verified(pairs, sets, name)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    for n in (100, 400):
        rows = near_copies(n)
        seen.append(0)
        have = sorted((tuple(r) for r in ngram_join.similar_documents(frame(spark, rows), bits=BITS).collect()), key=str)
        assert have == brute_similar(rows)
    assert seen[1] <= 5 * seen[0]


def test_rounds_end_where_no_pair_was_left_out(spark, monkeypatch):
    """Labels are taken anew only after a round that found a link, and no round follows one that compared all."""
    names = {"labels": [], "pairs": []}
    components_, verified = ngram_join.components, ngram_join._verified
    monkeypatch.setattr(ngram_join, "components", lambda links, name: names["labels"].append(name) or components_(links, name))
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, sets, name: names["pairs"].append(name) or verified(pairs, sets, name))
    for rows, most in ((near_copies(3), 2), ([r for r in made()], 2), (near_copies(60), 4)):
        names["labels"].clear(), names["pairs"].clear()
        have = sorted((tuple(r) for r in ngram_join.similar_documents(frame(spark, rows), bits=BITS).collect()), key=str)
        assert have == brute_similar(rows)
        assert len(names["labels"]) <= min(most, len(names["pairs"]))


def test_bit_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 3000))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.4, 1))], rng.integers(0, 2**63, int(rng.integers(0, 300))).astype(np.uint64)]))
        x, y = (ngram_join.bit_sketch(s).reshape(1, -1) for s in (a, b))
        words = min(x.shape[1], y.shape[1])
        far = int(np.bitwise_count(ngram_join.folded(x, words) ^ ngram_join.folded(y, words)).sum())
        assert far <= len(np.setxor1d(a, b))
        if words > 1 and 9 * len(np.setxor1d(a, b)) > 2 * (len(a) + len(b)):
            assert 9 * far > len(a) + len(b)  # twice the difference a link may have is told apart


def test_texts_of_one_id_keep_their_links(spark):
    """Each row of a repeated id has the component of its own text."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, c), (4, a.replace("a59", "x")), (5, b.replace("b59", "x")), (6, c.replace("c59", "x")), (6, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    have = sorted(tuple(r) for r in ngram_join.similar_documents(docs, bits=BITS).collect())
    assert have == sorted((i, 56, 1) for i, _ in rows)


def test_similar_documents_of_nothing(spark):
    assert ngram_join.similar_documents(frame(spark, made()).where("false"), bits=BITS).collect() == []


def test_unequal_chunks_bound_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        cut = int(len(a) * 0.1)
        b = np.unique(np.concatenate([a[cut // 2 :], rng.integers(0, 2**63, cut // 2).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram_join.signatures(a), ngram_join.signatures(b)))


ODD = ["", "a", "  a  b\n\nc ", "don't we'll 'S x'T", "été ÉÀß Straße", "<|endoftext|>x <|endoftext|>", "a<|startoftext|>b", "x\x1fy\x85z\xa0w",
       "日本語 テスト 😀 ok", "İstanbul ΑΣ ςσ", "a\tb\r\n c", "123 45,6 ½ x²", "\n", "\n\n a", "!!??.. --- x", "éa", "word " * 2000, "x" * 3000]


@pytest.mark.parametrize("kind,path", [(bpe.WordCoder, WORD_BPE), (bpe.ByteCoder, BYTE_BPE)])
def test_ids_are_those_of_the_library(kind, path):
    library, mine = Tokenizer.from_file(path), kind(path)
    for text, ids in zip(ODD, mine.encode(ODD), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, np.uint32).tolist() == want, text[:30]
        if kind is bpe.ByteCoder:
            assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_a_word_is_merged_once_whatever_stands_around_it():
    coder, met = bpe.WordCoder(WORD_BPE), []
    merge = coder.merger.merge
    coder.merger.merge = lambda words: met.extend(words) or merge(words)
    library = Tokenizer.from_file(WORD_BPE)
    for text in ("the reend thorwh", "The, reend. (THORWH) the;reend", "thorwh's reend!"):
        (ids,) = coder.encode([text])
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(met) == sorted([b"the", b"reend", b"thorwh", b",", b".", b"(", b")", b";", b"'s", b"!"])


@pytest.mark.parametrize("kind,path", [(bpe.WordCoder, WORD_BPE), (bpe.ByteCoder, BYTE_BPE)])
def test_forgotten_pieces_are_learned_again(kind, path, monkeypatch):
    monkeypatch.setattr(bpe, "MOST", 40)
    rng, library, mine = random.Random(5), Tokenizer.from_file(path), kind(path)
    words = ["".join(rng.choice("abet'É1,") for _ in range(rng.randrange(1, 6))) for _ in range(300)] + ["日本", "<|x", "\ue000z"]
    for _ in range(30):
        texts = [" ".join(rng.choice(words[: rng.choice((20, 303))]) for _ in range(rng.randrange(12))) for _ in range(9)]
        for text, ids in zip(texts, mine.encode(texts, 4), strict=True):
            assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(mine.known.number) < 40 + 4 * 12 and len(mine.words.number) < 40 + 4 * 12 * 6


def test_words_of_latin_1_are_cut_as_the_library_does():
    library, mine = Tokenizer.from_file(WORD_BPE), bpe.WordCoder(WORD_BPE)
    signs = [chr(c) for c in (*range(33, 127), *range(161, 256))]
    texts = [" ".join(a + b + "'ll" for b in signs) for a in signs] + ["x" + a + "''s'S'tt" + a for a in signs]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_lexicon_is_minimal_and_exact():
    words = {w.encode(): np.array([i, i + 1], np.uint32).tobytes() for i, w in enumerate("walking talking walked talked walk talk king".split())}
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(words))
    assert lexicon.ids_of(list(words)) == list(words.values())
    assert lexicon.ids_of([b"wal", b"walks", b"", b"xking", b"walkingg"]) == [None] * 5
    # root, the ways shared by walk and talk (4), i-n-g and e-d behind them (3), the end, and k of king, whose i is theirs
    assert len(lexicon.final) == 10
    assert bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({})).ids_of([b"a"]) == [None]


def test_encode_and_counts(spark):
    rows = [(i, t, "en", 1, "c", 2) for i, t in enumerate([*ODD, *ODD[:3], None])]
    library = Tokenizer.from_file(BYTE_BPE)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids for r in rows}
    for r in bpe_lexicon.encode(frame(spark, rows), BYTE_BPE, words=40, decode=True).collect():
        assert np.frombuffer(r["ids"], np.uint32).tolist() == want[r["carry"]["doc_id"]]
        assert r["decoded"] == library.decode(want[r["carry"]["doc_id"]], skip_special_tokens=False)
    sizes = np.array([len(x) for x in want.values()])
    found = token_counts.limits(token_counts.length_histogram(frame(spark, rows), BYTE_BPE)).collect()
    assert {r["length"] for r in found} == set(sizes.tolist())
    for r in found:
        assert (r["n_docs"], r["n_longer"]) == ((sizes == r["length"]).sum(), (sizes > r["length"]).sum())
        assert (r["total_tokens"], r["kept_tokens"]) == (sizes.sum(), np.minimum(sizes, r["length"]).sum())
    assert token_counts.length_histogram(frame(spark, rows).where("false"), BYTE_BPE).collect() == []


def test_packing(spark):
    rows = [(i, t, "en", 1, "c", 2) for i, t in enumerate([*ODD, *ODD[:3], None, "one two " * 3000, "z " * 4095])]
    library = Tokenizer.from_file(WORD_BPE)
    want = set()
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            cut = ids[a : a + 4096]
            want.add((r[0], k, a, len(cut), zlib.crc32(np.array(cut, np.uint32).tobytes())))
    out = packing.pack_documents(frame(spark, rows), WORD_BPE).select("carry.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    assert {tuple(r)[:5] for r in out} == want and len(out) == len(want)
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in out], 4096)
    assert len({r["sequence_id"] for r in out}) == -(-sum(r["length"] for r in out) // 4096)


def check_sequences(places, limit):
    at = {}
    for sequence, offset, length in sorted(places):
        assert at.get(sequence, 0) == offset
        at[sequence] = offset + length
        assert at[sequence] <= limit


def test_genetic_packing_beats_or_equals_best_fit(spark):
    rng = random.Random(9)
    lengths = [rng.choice((1400, 1365, 2700, 900, 2049, 3000, 700, 1366)) + rng.randrange(40) for _ in range(900)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    out = packing.pack_lengths(pieces, 4096, cell=300).collect()
    assert sorted(r["uid"] for r in out) == list(range(900))
    check_sequences([(r["sequence_id"], r["offset"], lengths[r["uid"]]) for r in out], 4096)
    plain = packing.best_fit(lengths, sorted(range(900), key=lambda x: -lengths[x]), 4096, [], [])
    assert len({r["sequence_id"] for r in out}) <= len(plain.bins) + 3
    assert packing.pack_lengths(pieces.where("false")).collect() == []


def test_crossover_keeps_every_piece_once():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 60) for _ in range(80)]
    a = packing.best_fit(lengths, list(range(80)), 100, [], [])
    b = packing.best_fit(lengths, list(range(79, -1, -1)), 100, [], [])
    for _ in range(30):
        child = packing.cross(a, b, lengths, 100, rng)
        assert sorted(x for items in child.bins for x in items) == list(range(80))
        assert [sum(lengths[x] for x in items) for items in child.bins] == child.fill and max(child.fill) <= 100


def test_language_model_holds_one_set_of_landmarks():
    """256 landmarks of one order are 64 MB unpacked; two and their scaled copies were held."""
    rng = np.random.default_rng(6)
    bits = [np.packbits(rng.random((len(langid.ORDERS), langid.PLACES)) < 0.002).tobytes() for _ in range(300)]
    tracemalloc.start()
    model = langid.solve([("de", "en")[i % 2] for i in range(300)], bits)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == ["de", "en"] and np.isfinite(model.weights).all()
    assert peak < 120 << 20


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), per_language=60, landmarks=64)
    assert model.languages == ["de", "en", "es", "fr"]
    out = langid.predict(docs.where(langid.held_out(F.col("doc_id"))), model).select("carry.lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def test_no_language_of_copies_is_without_a_sample(spark):
    """Few texts in many copies, and texts without a letter, do not take the share of the others."""
    words = {"en": "the and of cat dog", "fr": "le et de chat chien", "de": "der und von Katze Hund"}
    rows = [(i, f"{w} {k}", lang) for lang, w in words.items() for k in range(3) for i in range(400)]
    rows += [(i, f"{i} !", lang) for lang in words for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for most in (1, 2, 250):
        model = langid.train(docs, per_language=most, landmarks=16)
        assert model.languages == ["de", "en", "fr"]
        assert all(r["lang"] == r["lang_pred"] for r in langid.predict(docs.where("text like '%a%' or text like '%d%'").limit(50), model).select("carry.lang", "lang_pred").collect())


def test_language_of_odd_texts(spark):
    rows = [(1, "the cat and the dog", "en", 1, "c", 2), (2, "le chat et le chien", "fr", 1, "c", 2), (3, None, "fr", 1, "c", 2),
            (4, "", None, 1, "c", 2), (5, "12 34 !?", "en", 1, "c", 2), (6, "the hen and the fox", None, 1, "c", 2), (None, "le", None, None, None, None)]
    docs = frame(spark, rows)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, langid.train(docs)).select("carry.*", "lang_pred", "score").collect()}
    assert [found[i][0] for i in (1, 2, 6)] == ["en", "fr", "en"]
    assert [found[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    none = langid.train(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}
    held = {r[0]: r[1] for r in docs.select("doc_id", langid.held_out(F.col("doc_id"))).collect()}
    assert held == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in held}


def test_fingerprints(spark):
    rows = made()
    out = {r["doc_id"]: r for r in fingerprint.edited_halves(frame(spark, rows)).collect()}
    order = sorted(r[0] for r in rows if r[0] is not None)
    text = {r[0]: r[1] or "" for r in rows}
    for k, i in enumerate(order):
        a, b = text[i], text[order[(k + 1) % len(order)]]
        edited = a[: len(a) - len(a) // 2] + b[: len(a) // 2]
        assert (out[i]["n_chars"], out[i]["edited_sha256"]) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= out[i]["near_edited"] <= 1 and 0 <= out[i]["near_next"] <= 1
        assert (out[i]["fingerprint"] == out[i]["edited_fingerprint"]) == (a == edited)
    assert len({out[i]["fingerprint"] for i in order}) == len({text[i] for i in order})
    assert fingerprint.edited_halves(frame(spark, rows).where("false")).collect() == []


def test_fingerprints_add_up(spark):
    rows = [(1, "a\nb\nc\nd", "d\nb\na\nc", "a\nb", "c\nd")]
    df = spark.createDataFrame(rows, "id int, t string, u string, v string, w string")
    df = df.select(*(fingerprint.paragraph_hashes(F.col(c)).alias(c) for c in "tuvw"))
    df = df.select(*(fingerprint.lanes(F.col(c)).alias(c) for c in "tuvw"))
    t, u, v, w, both, less = df.select(
        "t", "u", "v", "w", fingerprint.combine(F.col("v"), F.col("w")), fingerprint.remove(F.col("t"), F.col("w"))
    ).first()
    assert t == u and both == t and less == v and v != w


def test_uneven_ids(spark):
    ids = [*range(20_000), 10**15]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    out = {r["doc_id"]: r["next_text"] for r in fingerprint.with_next(docs).collect()}
    assert all(out[a] == f"t{b}" for a, b in zip(ids, [*ids[1:], ids[0]], strict=True))


def test_native_fingerprints(spark):
    plan = fingerprint.edited_halves(frame(spark, made()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_public_tokenizers_stay_outside():
    for path in (BYTE_BPE, WORD_BPE):
        assert not os.path.abspath(path).startswith(os.path.dirname(os.path.dirname(os.path.abspath(packing.__file__))))
        with open(path, encoding="utf-8") as f:
            assert json.load(f)["model"]["type"] == "BPE"


def test_frequent_words_are_cut_by_a_filter(spark):
    rows = [(f"w{i}".encode(), n) for i, n in enumerate([1000, 900, 500, 100, 90, *[7] * 200, *[1] * 5000])]
    counts = spark.createDataFrame(rows, "word binary, n long")
    take = lambda n: sorted(r["n"] for r in bpe_lexicon.frequent_words(counts, n).collect())
    assert take(3) == [500, 900, 1000]
    assert take(205) == sorted([1000, 900, 500, 100, 90, *[7] * 200])
    assert 80 <= len(take(105)) <= 130 and set(take(105)) == {1000, 900, 500, 100, 90, 7}
    assert 1100 <= len(take(1205)) <= 1300
    assert len(take(10_000)) == len(rows) and bpe_lexicon.frequent_words(counts.limit(0), 5).collect() == []
