"""Vectors, fingerprints, components and decontamination against brute force."""

import random

import numpy as np
import pytest
import xxhash

from skyfold.llm import decontamination as dec
from skyfold.llm import embedding_dedup as emb
from skyfold.llm import simhash_dedup as sim
from skyfold.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def union(n, pairs):
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(50, i) for i in range(51, 70)] + [(5, 5), (80, 90), (90, 80)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    want = union(100, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in nodes if want[x] != x}
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_embedding_links_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    near = base[:20] + rng.normal(size=(20, 8)) * 0.15
    hot = np.tile(base[3], (15, 1)) + rng.normal(size=(15, 8)) * 0.01
    x = np.concatenate([base, near, hot, base[:5], 3 * base[5:8]]).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(len(x))]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 8, 1), (1003, [float("nan")] * 8, 1),
           (1004, [1.0, None] + [0.0] * 6, 1), (1005, [float("inf")] * 8, 1), (1006, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows + odd + [rows[0]], "vec_id long, embedding array<float>, n_links int")
    for tile in (16, 4096):
        got = emb.embedding_links(df, threshold=0.95, tile_rows=tile).collect()
        u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
        cos = u @ u.T
        linked = (cos >= 0.95) & ~np.eye(len(x), dtype=bool)
        comp = union(len(x), np.argwhere(linked).tolist())
        want = {(i, int(linked[i].sum()), comp[i], comp[i] == i) for i in range(len(x))}
        want |= {(i, 0, i, True) for i, *_ in odd}
        assert {tuple(r) for r in got} == want and len(got) == len(df.collect())
    assert emb.embedding_links(df.limit(0)).count() == 0


def brute_fp(text, k=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()]
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(60)]
    for t in texts[:30]:  # near copies: a word changed late in a long text
        w = t.split()
        w[-1] = "Changed"
        texts.append(" ".join(w))
    texts += [None, "", " \t\n", texts[0], texts[0].upper(), "ÀÉ one", "x" * 50_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, root int")
    fps = [brute_fp(t) for t in texts]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    comp = union(len(fps), pairs)
    got = {r.doc_id: (r.fp % 2 ** 64, r.component_id) for r in sim.simhash_groups(df).collect()}
    assert got == {i: (fps[i], comp[i]) for i in range(len(fps))}
    kept = sim.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(fps)) if comp[i] == i]


@pytest.mark.parametrize("distance", [1, 2])
def test_links_reach_every_distance(spark, distance):
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 2 ** 63, 40, dtype=np.int64)
    fps = set(seeds.tolist())
    for s in seeds[:20].tolist():  # near copies in a chain, bits in both segments and the sign bit
        for bits in ((0,), (5, 40), (63,), (33, 34)):
            v = s
            for b in bits:
                v ^= (1 << b) if b < 63 else -(1 << 63)
            fps.add(v)
    fps = sorted(fps)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i)
             if bin((fps[i] ^ fps[j]) % 2 ** 64).count("1") <= distance]
    comp = union(len(fps), pairs)
    got = {r.fp: r.root for r in sim.link_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long"), distance).collect()}
    assert got == {fps[i]: fps[comp[i]] for i in range(len(fps)) if fps[comp[i]] != fps[i]}


def test_repeated_and_null_ids_keep_one_row(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words here now"), (None, "quite something else"),
            (None, "quite something else"), (2, "a b c d"), (3, None), (4, "")]
    kept = sim.drop_near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [
        (1, "a b c d"), (1, "other words here now"), (None, "quite something else"), (3, None)]))
    assert sim.drop_near_duplicates(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def brute_contaminated(texts, items, k=5, t=0.8):
    out = {}
    for d, text in enumerate(texts):
        words = dec.words_of(text)
        for i, item in items:
            iw = dec.words_of(item)
            if not iw or not words:
                continue
            kk, size = min(k, len(iw)), min(len(iw), len(words))
            if size < kk:
                continue
            want = dec.shingle_counts(iw, kk)
            best = max(dec.similarity(dec.shingle_counts(words[s:s + size], kk), want)
                       for s in range(len(words) - size + 1))
            if best >= t:
                out[d, i] = best
    return out


def test_contaminated_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(80)]
    say = lambda n: rng.choices(vocab, k=n)
    items = [(i, " ".join(say(n))) for i, n in enumerate([1, 3, 5, 6, 12, 20, 20, 45])] + [(90, None), (91, " .. "), (None, "v1")]
    texts = [None, "", "?!", " ".join(say(2000))]
    for i, (_, item) in enumerate(items[2:8]):
        w = item.split()
        texts += [" ".join(say(30) + w + say(30)), item.upper().replace(" ", ", "), " ".join(w[:-1])]
        w[len(w) // 2] = "changed"
        texts += [" ".join(say(9) + w), " ".join(say(4) + w + say(3) + item.split())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    want = brute_contaminated(texts, [x for x in items if x[0] is not None])
    for chars in (100, 10 ** 6):  # several blocks, one block
        got = {(r.doc_id, r.item_id): r.similarity for r in dec.contaminated(docs, bench, block_chars=chars).collect()}
        assert got == pytest.approx(want)
    clean = dec.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert dec.contaminated(docs, bench.limit(0)).count() == 0 and dec.drop_contaminated(docs, bench.limit(0)).count() == len(texts)


def test_decontamination_parts_words_at_any_punctuation(spark):
    """A verbatim item between curly quotes, and one whose blanks are no-break spaces, is found with similarity one."""
    words = [f"wörd{i}" if i % 5 == 0 else f"word{i}" for i in range(15)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    texts = ["he said: \u201c" + " ".join(words) + "\u201d\u2014and left", "\u00a0".join(words), "\u3001".join(words) + "\u3002",
             "\u2026".join(words).upper(), " ".join(words[:7])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.similarity for r in dec.contaminated(docs, bench).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0}
    assert dec.words_of("Ab_c\u2019d 1\u00a02") == [b"ab", b"c", b"d", b"1", b"2"]


def _search_cost(items, text):
    """(found, seconds, megabytes over the words of the text)."""
    import time
    import tracemalloc

    index = dec.BenchmarkIndex(items, 5, 0.8, dec.RADIUS)
    dec.words_of(text)
    tracemalloc.start()
    start = time.monotonic()
    found = index.search(text)
    took, peak = time.monotonic() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found, took, peak / 1e6


def test_a_stem_that_all_items_share_costs_little():
    rng = random.Random(8)
    stem = "which one of the following statements is the best answer"
    items = [(i, f"{stem} " + " ".join(f"w{rng.randint(0, 5000)}" for _ in range(20))) for i in range(3000)]
    text = " ".join(f"{stem} " + " ".join(f"x{rng.randint(0, 5000)}" for _ in range(10)) for _ in range(200))
    found, took, peak = _search_cost(items, text)
    assert found == [] and took < 2 and peak < 100, (took, peak)
    found, took, peak = _search_cost(items, text + " " + items[77][1])
    assert [f[0] for f in found] == [77] and took < 2 and peak < 100, (took, peak)


def test_an_item_at_both_ends_of_a_very_long_text():
    rng = random.Random(9)
    item = " ".join(f"q{i}" for i in range(40))
    words = " ".join(f"n{rng.randint(0, 300_000)}" for _ in range(1_000_000))
    found, took, peak = _search_cost([(1, item)], f"{item} {words} {item}")
    assert found == [(1, 1.0, 0, 40)] and peak < 350, (took, peak)    # the words themselves are 200 MB of it


def test_window_slices_cover_each_place_once():
    rng = random.Random(2)
    for _ in range(200):
        last, size = rng.randint(0, 60), rng.randint(1, 12)
        at = np.array(sorted(rng.sample(range(last + size), rng.randint(1, min(6, last + size)))))
        got = [int(x) for piece in dec.window_slices(at, size, last) for x in piece]
        assert got == [s for s in range(last + 1) if any(s <= p < s + size for p in at)]


def test_recall_of_changed_copies():
    """Copies with words changed, by their similarity: all of those at the threshold or above are found."""
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(15, 80)))) for i in range(60)]
    index = dec.BenchmarkIndex(items, 5, 0.8, dec.RADIUS)
    texts = []
    for _, item in items:
        for changes in range(4):
            words = item.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(rng.choices(vocab, k=rng.randint(0, 50)) + words + rng.choices(vocab, k=rng.randint(0, 50))))
    want = brute_contaminated(texts, items)
    got = {(d, f[0]): f[1] for d, text in enumerate(texts) for f in index.search(text)}
    assert got == pytest.approx(want) and sum(0.8 <= s < 1 for s in want.values()) > 30
