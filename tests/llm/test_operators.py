"""The operators for training data against brute force on small tables with nulls, ties, repeats and long texts."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltline.llm import components, language, licences, mixing, pieces, ranking, sharding, simhash, substrings, suffix_array, vectors, weighted_sampling
from siltline.llm.common import Scratch, mix, window_hash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id int, size string"


@pytest.fixture(scope="module")
def texts():
    """Random words; copies, near copies, a shared passage, empty, null, wordless and long texts."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = prose(60)
    out = [prose(120) for _ in range(12)]
    near = out[0].split()
    near[60] = "changed"
    out += [out[1], out[1], " ".join(near), f"{prose(30)} {shared} {prose(20)}", f"{shared} {prose(40)}", f"{prose(5)}\n{shared}",
            "", None, " \t\n", "one", "one two", prose(3000), "x" * 5000, f"Released under the MIT License.\n{prose(9)}", "123 456"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], None if t is None else len(t), 7, "s") for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", "a", 10, 7, "s"), rows[3], (rows[4][0], "another text of the same id", "en", "a", 27, 7, "s")]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for run in (simhash.near_duplicates, simhash.keep_one, weighted_sampling.fingerprints, suffix_array.repeated_passages, suffix_array.drop_passages,
                pieces.digests, substrings.remove, sharding.interleave, language.identify, language.accepted, mixing.mixture, mixing.take):
        assert run(empty).count() == 0, run
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_simhash(docs):
    rows = rows_of(docs)
    prints = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)))
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(rows))]
    least = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c and rows[i][0] is not None), default=None) for c in label}
    want = Counter((rows[i][0], f"{prints[i]:016x}", least[label[i]]) for i in range(len(rows)))
    assert Counter(tuple(r)[:3] for r in simhash.near_duplicates(docs).collect()) == want


def test_simhash_large_buckets_link_like_small_ones():
    r = np.random.default_rng(1)
    for block, (shift, width) in enumerate(simhash.BLOCKS):
        keep = ((1 << 64) - 1) ^ (((1 << width) - 1) << shift)
        key = int(r.integers(1 << 63)) & keep
        bits = [i for i in range(64) if keep >> i & 1]
        found = {key ^ (1 << int(r.choice(bits)) if r.random() < .7 else 0) ^ sum(1 << shift + int(x) for x in r.choice(width, r.integers(0, 4), replace=False)) for _ in range(300)}
        prints = np.array(sorted(found), np.uint64)
        small, large = (dict(zip(*(x.tolist() for x in simhash._forest(a, b)))) for a, b in (simhash._close(prints), simhash._lookup(prints, block, np.uint64(key))))
        a, b = simhash._lookup(prints, block, np.uint64(key))
        assert (np.bitwise_count(a ^ b) <= simhash.RADIUS).all()
        near = [(x, y) for x in found for y in found if (x ^ y).bit_count() <= 3 and (x ^ y) & keep == 0 and x & keep == key]
        assert all(large.get(x, x) == large.get(y, y) for x, y in near)
        assert small.keys() >= set() and len(large) <= len(prints)


def test_keep_one(docs):
    """Of each component of the fingerprints the smallest doc_id, nulls last, by brute force."""
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows, least = docs.collect(), {}
    for r, x in zip(rows, [labels[r.doc_id, r.text] for labels in [brute_components(docs)] for r in rows], strict=True):
        key = (r.doc_id is None, r.doc_id or 0)
        least[x] = min(least.get(x, key), key)
    out = kept.collect()
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in out) == Counter(least.values())
    assert set(map(tuple, out)) <= set(map(tuple, rows))


def brute_components(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [simhash.fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(rows))]
    return {row: x for row, x in zip(rows, label, strict=True)}


def test_keep_one_takes_the_same_row_in_every_order(spark):
    rows = [(1, "one text of some words", lang, "s", 3, 7, size) for lang in ("en", "fr", None) for size in ("x", "y")]
    got = {tuple(simhash.keep_one(spark.createDataFrame(order, SCHEMA).repartition(n)).first()) for n, order in ((1, rows), (3, rows), (2, rows[::-1]))}
    assert len(got) == 1 and got <= set(rows)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (5, 5)]
    out = components.components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.label for r in out.collect()} == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_weighted_sampling(docs):
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is None, -(r[0] or 0), [-c for c in hashlib.md5((r[1] or "").encode()).digest()]))
    want = []
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        edited = t[:len(t) - n] + after[:n]
        own, changed, other = (weighted_sampling.sample(weighted_sampling.terms(x)) for x in (t, edited, after))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(), float((own == changed).mean()), float((own == other).mean())))
    assert sorted(map(tuple, weighted_sampling.fingerprints(docs, least_rows=3).collect()), key=repr) == sorted(want, key=repr)


def test_weighted_sampling_estimates_jaccard():
    a, b = Counter({(b"%d" % i,): 1 + i % 5 for i in range(300)}), Counter({(b"%d" % i,): 1 + i % 3 for i in range(100, 400)})
    both = set(a) | set(b)
    true = sum(min(a[x], b[x]) for x in both) / sum(max(a[x], b[x]) for x in both)
    hashed = lambda c: tuple(np.array(x, np.uint64) for x in zip(*sorted((xxhash.xxh64_intdigest(w[0], 3), n) for w, n in c.items()), strict=True))
    x, y = (weighted_sampling.sample(hashed(c), 2048, 3) for c in (a, b))
    assert abs(weighted_sampling.likeness(x, y) - true) < 0.06


def plain_sample(text, samples=64, seed=2010):
    """The sampling in loops, a term and a sample at a time."""
    words = text.encode().split()
    pairs = Counter(b" ".join(p) for p in zip(words, words[1:])) if len(words) > 1 else Counter(words)
    if not pairs:
        return [0] * samples
    one, f = lambda x: int(mix(np.array([x], np.uint64))[0]), np.float32
    part = lambda v: (f(v) + f(0.5)) / f(1 << 24)
    out = []
    for s in range(samples):
        best = None
        for h, n in sorted((xxhash.xxh64_intdigest(p, seed), n) for p, n in pairs.items()):
            x = one(one(h) ^ one((s + seed * (1 << 40) + 1) % (1 << 64)))
            y = one(x ^ 0xC0FFEE)
            r, c = (max(-np.log(part(v >> 40) * part(v >> 16 & 0xFFFFFF)), f(1e-7)) for v in (x, y))
            beta = part((x & 0xFFFF) << 8 | y & 0xFF)
            t = np.floor(f(np.log(float(n))) / r + beta)
            ln_a = np.log(c) - r * (t - beta + f(1))
            if best is None or ln_a < best[0]:
                best = (ln_a, h, int(t))
        out.append(one(best[1] ^ one(best[2])) >> 48)
    return out


def test_weighted_sampling_equals_plain_loops(texts):
    for t in ["a", "a b", "a b a b a b c", "x " * 40, "é ü é ü", *[t for t in texts if t and len(t) < 900][:5]]:
        got = weighted_sampling.sample(weighted_sampling.terms(t)).tolist()
        want = plain_sample(t)
        assert sum(a != b for a, b in zip(got, want, strict=True)) <= 1  # float32 logarithms of one and of many may differ in the last bit


def test_pairs_of_joined_texts(texts):
    r = random.Random(6)
    some = [t or "" for t in texts if len(t or "") < 4000] + [" a b", "a b ", "a", "", "ab cd ef gh ij", "é è ê ë", "\u00a0a b\u00a0c d \u2003", "\x1ca b c \x1c d e\x0b"]
    for _ in range(300):
        a, b = r.choice(some), r.choice(some)
        head, tail = a[:r.randrange(0, len(a) + 1)], b[:r.randrange(0, len(b) + 1)]
        got = weighted_sampling.joined(weighted_sampling.Pairs(a), head, weighted_sampling.Pairs(b), tail)
        assert got.hashes.tolist() == weighted_sampling.Pairs(head + tail).hashes.tolist()


def test_weighted_sampling_of_long_unrelated_texts():
    x, y = (weighted_sampling.sample(weighted_sampling.terms(" ".join(f"{k}{i}" for i in range(220_000)))) for k in "ab")
    assert weighted_sampling.likeness(x, y) < 0.05


def test_licences(docs):
    found = {r.doc_id: (r.licences, [n.place for n in r.notices]) for r in licences.scan(docs).where("doc_id > 4 or doc_id is null").collect()}
    assert found[25] == (["mit"], [0])
    assert all(v == ([], []) for k, v in found.items() if k != 25)


def test_licences_in_wrapped_headers(spark):
    heads = {
        "gpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
        "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"}
    rows = [(i, f"w1 w2 w3\n\n{t}\n\nw4 w5", "en", "a", 0, 7, "s") for i, t in enumerate(heads.values())]
    docs = spark.createDataFrame([*rows, (9, "the general\nsource of the river\nis under version", "en", "a", 0, 7, "s")], SCHEMA)
    out = {r.doc_id: (r.licences, [n.place for n in r.notices], r.unknown) for r in licences.scan(docs).collect()}
    assert {i: out[i][:2] for i in range(3)} == {i: ([f], [2]) for i, f in enumerate(heads)} and out[9] == ([], [], 0)


def test_licences_learn_from_all_lines(spark):
    """Near misses that the 2,000 lines of the least hash, which were once all that was learned from, leave out."""
    plain = [f"w{i} w{i * 7} w{i * 13}" for i in range(5000)]
    odd = spark.createDataFrame([(f"all rights x{i} reserved",) for i in range(400)], "line string")
    odd = [r.line for r in odd.where("xxhash64(line) > 0").orderBy("line").limit(150).collect()]
    lines = spark.createDataFrame([(x,) for x in plain + odd], "line string")
    assert lines.orderBy(F.xxhash64("line")).limit(2000).where("line like 'all rights%'").isEmpty() and len(odd) == 150
    texts = ["\n".join((plain + odd)[i:i + 103]) for i in range(0, 5150, 103)] + ["w1 w2\n\nReleased under the MIT license."]
    docs = spark.createDataFrame([(i, t, "en", "a", 0, 7, "s") for i, t in enumerate(texts)], SCHEMA)
    out = {r.doc_id: (r.licences, r.unknown) for r in licences.scan(docs).collect()}
    assert sum(u for _, u in out.values()) <= 5 and out[50] == (["mit"], 0)


def covered(words, n):
    count = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        mark = [False] * len(w)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                mark[i:i + n] = [True] * n
        out.append(mark)
    return out


def test_substrings(docs):
    rows = rows_of(docs)
    words = [(t or "").encode().split() for _, t in rows]
    want = Counter((i, len(w), sum(m), hashlib.sha256(b" ".join(x for x, g in zip(w, m) if not g)).hexdigest()) for (i, _), w, m in zip(rows, words, covered(words, 35)))
    assert Counter(map(tuple, substrings.remove(docs).collect())) == want


def test_passages(docs):
    rows = rows_of(docs)
    words = [(t or "").encode().split() for _, t in rows]
    want = Counter((i, len(w), sum(m)) for (i, _), w, m in zip(rows, words, covered(words, 50)))
    out = suffix_array.repeated_passages(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_repeated) for r in out) == want
    assert {r.doc_id: r.n_removed for r in out if r.doc_id in (15, 16, 17)} == {15: 0, 16: 60, 17: 60}


def test_drop_passages_keeps_the_first_and_the_layout(docs, texts):
    kept = suffix_array.drop_passages(docs)
    assert kept.columns == docs.columns
    by_id = {r.doc_id: r.text for r in kept.where("doc_id not in (3, 4)").collect()}
    assert by_id[15] == texts[15] and by_id[17].split() == texts[17].split()[:5] and 13 not in by_id and by_id[21] == texts[21]


def test_passages_around_one_frequent_line_stay_where_they_are_first(spark):
    r = random.Random(11)
    prose = lambda n: [f"v{r.randrange(10 ** 6)}" for _ in range(n)]
    line = prose(30)
    rows = [prose(25) + line + prose(20) for _ in range(40)]
    rows = [w for p in rows for w in (p, prose(10) + p)] + [[w for _ in range(3) for w in (*rows[0][:60], *prose(7))]]
    docs = spark.createDataFrame([(i, " ".join(w), "en", "a", 0, 7, "s") for i, w in enumerate(rows)], SCHEMA)
    count = Counter(tuple(w[i:i + 50]) for w in rows for i in range(len(w) - 49))
    out = {x.doc_id: x for x in suffix_array.repeated_passages(docs).collect()}
    assert [out[i].n_removed for i in range(80)] == [0, 75] * 40 and out[80].n_removed == 3 * 60
    kept = {x.doc_id: x.text.split() for x in suffix_array.drop_passages(docs).collect()}
    left = Counter(tuple(w[i:i + 50]) for w in kept.values() for i in range(len(w) - 49))
    assert all(left[w] == 1 for w, n in count.items() if n > 1)


def test_passages_are_found_that_end_after_a_frequent_run(spark):
    r = random.Random(12)
    prose = lambda n: [f"v{r.randrange(10 ** 6)}" for _ in range(n)]
    low = lambda w: int(mix(window_hash(np.array([xxhash.xxh64_intdigest(x.encode(), 7) for x in w], np.uint64), 20) ^ np.uint64(0x5EED))[0])
    run, left = min((prose(20) for _ in range(2000)), key=low), [prose(30) for _ in range(30)]  # the minimiser of each passage
    rows = [x + run + prose(40) for x in left for _ in range(2)]
    docs = spark.createDataFrame([(i, " ".join(w), "en", "a", 0, 7, "s") for i, w in enumerate(rows)], SCHEMA)
    out = {x.doc_id: x.n_repeated for x in suffix_array.repeated_passages(docs).collect()}
    assert out == {i: sum(m) for i, m in enumerate(covered(rows, 50))} and min(out.values()) == 50


def test_pieces(docs):
    import sentencepiece

    with open(pieces.MODEL, "rb") as f:
        model = f.read()
    plain, varied = pieces.Pieces(model, 0.0), pieces.Pieces(model)
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    hard = ["", " ", "  a  b ", "▁", "a▁b ▁", "tab\tand\nline", "naïve 東京 🙂 \x00", "x" * 300, " lead"]
    for text in [*hard, *(t for _, t in rows_of(docs) if t)]:
        for p in (plain, varied):
            assert p.decode(p.encode(text, 1)) == text
        if text and "▁" not in text:
            assert list(memoryview(plain.encode(text)).cast("i")) == library.encode(text)
    long = varied._merge_long("unbelievablywords", 12345 << 50)
    assert long == varied._merge_short("unbelievablywords", 12345 << 50)
    texts = [t for _, t in rows_of(docs) if t and len(t) > 400]
    assert any(varied.encode(t, 0) != varied.encode(t, 1) for t in texts) and any(varied.encode(t) != plain.encode(t) for t in texts)
    out = pieces.encode(docs).collect()
    assert Counter((r.doc_id, r.decoded) for r in out) == Counter(rows_of(docs))


def test_pieces_of_many_words_at_a_time(texts):
    """The agenda of many words gives what each word's own agenda gives, for all kinds of choices; and texts together what they give alone."""
    r = random.Random(12)
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    letters = "▁aeinrstéñ漢#&\x00🙂"
    words = [("▁" * r.randrange(0, 3) + "".join(r.choice(letters) for _ in range(r.randrange(0, 40))) or "x", r.choice((0, 1, 2, 5, r.getrandbits(8), r.getrandbits(32)))) for _ in range(600)]
    words += [("▁▁", 0), ("▁international", 0), ("▁international", 3), ("a", 1)]
    for (unit, mask), ids in zip(words, own._agenda.segment(words), strict=True):
        assert ids is None or ids == own._segment(unit, mask), unit
    assert sum(ids is None for ids in own._agenda.segment(words)) < 600
    keyed = [(t or "", i) for i, t in enumerate([*texts, "▁x ▁▁ y", "漢字 テスト", "\x00 a", " "])]
    alone = [pieces.Pieces.encode(own, t, k) for t, k in keyed]
    assert own.encode_all(keyed) == alone and [own.decode(x) for x in alone] == [t for t, _ in keyed]


def test_pieces_with_a_small_memory(texts, monkeypatch):
    with open(pieces.MODEL, "rb") as f:
        model = f.read()
    keyed = [(t or "", i) for i, t in enumerate(texts)]
    want = pieces.Pieces(model).encode_all(keyed)
    monkeypatch.setattr(pieces, "CACHE", 50)
    monkeypatch.setattr(pieces, "TOGETHER", 300)
    monkeypatch.setattr(pieces, "ROWS", 7)
    assert pieces.Pieces(model).encode_all(keyed) == want


def test_pieces_are_learned_once_and_forgotten(texts, monkeypatch):
    """A word with its choices is segmented once, whatever the number of its texts; the ids are those of each word's own agenda."""
    with open(pieces.MODEL, "rb") as f:
        own = pieces.Pieces(f.read())
    keyed = [(t, k) for k, t in enumerate([*(t for t in texts if t), "unbelievablywords" * 9 + " \x00 漢字 ▁ ▁▁", "x" * 40 + " " + "ab" * 30, ""])]
    asked, learn = Counter(), own._learn
    monkeypatch.setattr(own, "_learn", lambda units, masks: asked.update(zip(units, masks, strict=True)) or learn(units, masks))
    want = []
    for text, key in keyed:
        units = own._units(text)
        draws = [own._more(u, key, i, d) if len(u) > 8 else d for i, (u, d) in enumerate(zip(units, own._draws(key, len(units)), strict=True))]
        want.append(b"".join(own._segment(u, d) for u, d in zip(units, draws, strict=True)))
    assert own.encode_all(keyed) == want and own.encode_all(keyed[::-1]) == want[::-1]
    assert all(n == 1 for (_, m), n in asked.items() if m < 1 << pieces.DRAWN) and len(asked) < sum(len(own._units(t)) for t, _ in keyed)
    monkeypatch.setattr(pieces, "CACHE", 50)
    assert own.encode_all(keyed) == want and not own._known and not own._numbers and not own._ids.n


def test_pieces_vary_by_occurrence():
    with open(pieces.MODEL, "rb") as f:
        model = f.read()
    varied, again = pieces.Pieces(model), pieces.Pieces(model)
    n, word = 4000, "▁international"
    units = [varied.encode("international " * n, varied.key(doc)) for doc in (1, 2)]
    assert units[0] != units[1] and again.encode("international " * n, again.key(1)) == units[0]
    draws = varied._draws(varied.key(1), n)
    ways = Counter(varied._segment(word, x) for x in draws)
    assert len(ways) > 4 and b"".join(varied._segment(word, x) for x in [varied._more(word, varied.key(1), i, d) for i, d in enumerate(draws)]) == units[0][:-4]
    assert abs(sum(x.bit_count() for x in draws) / (32 * n) - 0.1) < 0.005
    long = "unbelievablywords" * 9
    assert all(varied._merge_short(long, m) == varied._merge_long(long, m) for m in (0, 5, *(varied._more(long, 7, i, i) for i in range(20))))


@pytest.mark.parametrize("fan", [1, 3, 1000])
def test_running_sums_by_bins_of_bins(spark, fan):
    r = random.Random(fan)
    rows = [(r.choice("abc"), r.randrange(40), r.random(), r.randrange(9)) for _ in range(500)]
    df = ranking.running(spark.createDataFrame(rows, "g string, bin long, at double, n int"), ["g"], "bin", ["at"], "n", "start", fan)
    want = [(*row, sum(x[3] for x in rows if x[0] == row[0] and x[1:3] < row[1:3])) for row in rows]
    assert sorted((x.g, x.bin, x.at, x.n, x.start) for x in df.collect()) == sorted(want)
    flat = ranking.running(spark.createDataFrame(rows, "g string, bin long, at double, n int"), [], "bin", ["at"], "n", "start", fan)
    assert sorted((x.bin, x.at, x.start) for x in flat.collect()) == sorted((*row[1:3], sum(x[3] for x in rows if x[1:3] < row[1:3])) for row in rows)


def test_sharding(docs):
    out = sharding.interleave(docs, shards=4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows_of(docs))
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_vectors(spark):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, base[:20] + 0.15 * r.standard_normal((20, 8)), np.repeat(base[:1], 5, 0), base[1:2] + 0.3 * r.standard_normal((60, 8))]))]
    odd = [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [None] * 8), (504, []), (505, [float("inf")] * 8), (506, [1.0, 2.0])]
    out = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in vectors.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()}
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    label = np.arange(len(rows))
    for _ in rows:
        label = np.where(near, label[None, :], 999).min(1)
    assert {i: out[i] for i, _ in rows} == {i: (int(near[i].sum()) - 1, int(label[i]), int(label[i]) == i) for i, _ in rows}
    assert all(out[i] == (0, i, True) for i, _ in odd)


def test_language(spark):
    r = random.Random(2)
    kinds = {"aa": "the of and to in is".split(), "bb": "der die und das ist nicht".split(), "cc": "el la que los por una".split()}
    rows = [(i, " ".join(r.choice(kinds[k]) for _ in range(30)), k, "s", 0, 0, "") for i in range(90) for k in [list(kinds)[i % 3]]]
    rows += [(200, None, "aa", "s", 0, 0, ""), (201, "12 + 34", "bb", "s", 0, 0, ""), (202, "", None, "s", 0, 0, ""), (None, "und das", None, "s", 0, 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {x.doc_id: x for x in language.identify(docs).collect()}
    assert all(out[i].lang_pred == k and 0 < out[i].score <= 1 for i, _, k, *_ in rows[:90])
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(90))
    assert [out[i].lang_pred for i in (200, 201, 202, None)] == ["und", "und", "und", "bb"]
    assert language.accepted(docs).count() == 91


def plain_language(learned, text):
    """Out-of-place distance by counting n-grams in loops."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    padded = " " + "".join(c for i, c in enumerate(letters) if c != " " or (i and letters[i - 1] != " ")).strip() + " "
    if not padded.strip():
        return "und", 0.0
    number = lambda g: sum((1 if c == " " else ord(c) + 1) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    n = Counter(number(padded[i:i + k]) for k in (1, 2, 3) for i in range(len(padded) - k + 1) if (padded[i] if k == 1 else padded[i + 1] if k == 3 else padded[i:i + 2].strip()) not in (" ", ""))
    own = dict(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:language.PROFILE])
    best = None
    for name in sorted(learned):
        place = {g: i for i, g in enumerate(learned[name])}
        far = sum(abs(place.get(g, language.PROFILE) - sum(m > c for m in own.values())) for g, c in own.items())
        if best is None or far < best[0]:
            best = (far, name)
    return best[1], 1 - best[0] / (len(own) * language.PROFILE)


def test_language_equals_plain_counting(spark, texts):
    many = " ".join(chr(c) for c in range(0x4E00, 0x4E00 + 400))
    more = [many, "".join(chr(c) for c in range(0x4E00, 0x5400)), "ñ", "a1b", "  x  y ", "İß ﬁ Ω", many * 3 + " der die das", "\U0001F642 a", "x" * 3000 + " y"]
    every = [t for t in [*texts, *more]]
    rows = [(i, t, ("aa", "bb", "cc")[i % 3], "s", 0, 0, "") for i, t in enumerate(every)]
    docs = spark.createDataFrame(rows, SCHEMA)
    learned = language.profiles(docs.where(~language.held_out()))
    assert all(len(p) <= language.PROFILE for p in learned.values())
    for r in language.identify(docs).collect():
        lang, score = plain_language(learned, every[r.doc_id])
        assert (r.lang_pred, r.score) == (lang, pytest.approx(score)) and 0 <= r.score <= 1


def test_language_of_many_letters_without_the_table(monkeypatch, texts):
    learned = {"aa": [98 << 21 | 99, 98, 110], "bb": [120, 121]}
    want = language.predict(learned, texts)
    monkeypatch.setattr(language, "TABLE", 0)
    assert language.predict(learned, texts) == want


def test_targets_and_seats():
    assert mixing.targets([10, 1000, 1000], [5, 2, 1]) == [Fraction(30), Fraction(3960, 3), Fraction(1980, 3)]
    shares, blocks = [Fraction(x) for x in (53, 24, 23)], 17
    have = [0, 0, 0]
    for _ in range(blocks):
        have[max(range(3), key=lambda i: (shares[i] / (2 * have[i] + 1), -i))] += 1
    assert mixing.seats(shares, blocks, [99] * 3) == have
    assert mixing.seats(shares, blocks, [4, 99, 99])[0] == 4 and sum(mixing.seats(shares, blocks, [4, 99, 99])) == blocks


def test_mixture(docs):
    out = mixing.mixture(docs).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len((t or "").split())) for i, t in rows_of(docs))
    assert all(r.taken <= 3 * r.size for r in out)
    for size in {r.source_size for r in out}:
        own = [r for r in out if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.02 * own[0].target + 2
    assert sorted(map(tuple, mixing.mixture(docs).collect()), key=repr) == sorted(map(tuple, out), key=repr)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    assert sum(len(r.text.split()) for r in taken.collect()) == sum(r.taken for r in out)


def test_take_keeps_equal_rows_of_two_sources_apart(spark):
    rows = [(1, "x y z w", s, lang, 1, 2, "") for s, lang in (("en", "s1"), ("fr", "s2"), ("de", "s2"))]
    rows = [(i, t, lang, source, 0, 0, "") for i, t, lang, source, *_ in rows]
    rows += [(2, "x y z w " * 40, "en", "s1", 0, 0, ""), (3, "a b c d " * 40, "fr", "s2", 0, 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.take(docs).collect()
    taken = Counter()
    for r in mixing.mixed(docs)[0].collect():
        taken[r.source] += r.taken
    words = Counter()
    for r in out:
        words[r.source] += len(r.text.split())
        assert (r.source, r.lang) in {("s1", "en"), ("s2", "fr"), ("s2", "de")}
    assert words == +taken
