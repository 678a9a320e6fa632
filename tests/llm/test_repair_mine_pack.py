"""op11, op12 and op13 against brute force."""

import functools
import hashlib
import random
import re
import zlib
from bisect import insort

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfold.llm import conversation_repair, hard_negatives, packing
from skyfold.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


# -- op11 -----------------------------------------------------------------
def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif shown[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append(None)
        seen.add((role, text))
    return out


def _all_edits(rows, faults, inserts):
    """Every sequence of edits with at most ``inserts`` insertions: (cost, letters, roles, texts)."""
    if inserts:
        for role in ("user", "assistant"):
            for c, e, r, t in _all_edits(rows, faults, inserts - 1):
                yield c + 5, "I" + e, [role] + r, [""] + t
    if not rows:
        yield 0, "", [], []
        return
    (role, text), fault = rows[0], faults[0]
    for c, e, r, t in _all_edits(rows[1:], faults[1:], inserts):
        yield c + 2, "D" + e, r, t
        if fault not in ("blank", "duplicate"):
            extra = 5 * (fault == "truncated")
            if role:
                yield c + extra, "K" + e, [role] + r, [text] + t
            for new in ("user", "assistant"):
                yield c + 1 + extra, "R" + e, [new] + r, [text] + t


def _best_edits(rows):
    faults = _faults(rows)
    # Deleting all costs 2 a row, so more than 2n / 5 insertions are never cheapest.
    legal = [x for x in _all_edits(rows, faults, 2 * len(rows) // 5)
             if re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in x[2]))]
    cost, letters, roles, texts = min(legal, key=lambda x: x[:2])
    return cost, letters, [f"{r}:{t}" for r, t in zip(roles, texts)], faults


def _viterbi(rows):
    out = []
    search = conversation_repair.Viterbi(lambda *edit: out.append(edit))
    for (role, text), fault in zip(rows, _faults(rows)):
        search.add(role, fault, text)
    cost = search.close()
    return cost, "".join(e[0] for e in out), [f"{e[1]}:{e[2] or ''}" for e in out if e[0] != "D"]


_ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "s", ""]),
                           st.sampled_from(["a.", "b!", "c", "", " \t", "d?", "e"])), max_size=5)


@settings(max_examples=300, deadline=None)
@given(_ROWS)
def test_edits_are_the_cheapest_and_least(rows):
    assert _viterbi(rows) == _best_edits(rows)[:3]


def _string_dp(roles, faults):
    """The same optimum with whole strings per state, for longer conversations."""
    moves = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def inserted(best):
        for _ in range(3):
            for initial in "ua":
                for a, b in moves[initial].items():
                    if a in best:
                        best[b] = min(best.get(b, (9 ** 9, "")), (best[a][0] + 5, best[a][1] + "I"))
        return best

    best = inserted({0: (0, "")})
    for role, fault in zip(roles, faults):
        new = {}
        for state, (cost, letters) in best.items():
            options = [(state, 2, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                options += [(moves[i][state], price + extra, letter) for i, price, letter in
                            ((role[:1], 0, "K"), ("u", 1, "R"), ("a", 1, "R")) if state in moves.get(i, {})]
            for to, price, letter in options:
                new[to] = min(new.get(to, (9 ** 9, "")), (cost + price, letters + letter))
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def test_long_conversations_equal_whole_string_search_and_settle():
    rng = random.Random(5)
    for kind in range(40):
        n = 400
        roles = [rng.choice(["system", "user", "assistant", "tool"][:rng.randint(1, 4)]) for _ in range(n)]
        faults = [rng.choice([None, "blank", "duplicate", "truncated"][:rng.randint(1, 4)]) for _ in range(n)]
        out = []
        search = conversation_repair.Viterbi(lambda *e: out.append(e))
        behind = 0
        for i, (role, fault) in enumerate(zip(roles, faults)):
            search.add(role, fault, i)
            behind = max(behind, i + 1 - sum(e[2] is not None for e in out))
        cost = search.close()
        assert (cost, "".join(e[0] for e in out)) == _string_dp(roles, faults)
        assert [e[2] for e in out if e[2] is not None] == list(range(n))
        assert behind < 150, behind      # edits are emitted on the way, not at the end


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _expected_digests(rows):
    convs = {r[0]: [] for r in rows}
    for r in _damaged(rows):
        convs[r[0]].append(r[1:])
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        plain = [r[1:] for r in own]
        faults = _faults(plain)
        cost, letters = _string_dp([r for r, _ in plain], faults)
        parts, at, state = [], 0, ""
        for letter in letters:      # positions decide the roles of reroled and inserted rows
            if letter in "RI":
                state = "a" if state == "u" else "u"
                parts.append({"a": "assistant", "u": "user"}[state] + ":" + (plain[at][1] if letter == "R" else ""))
            elif letter == "K":
                state = plain[at][0][0]
                parts.append(":".join(plain[at]))
            at += letter != "I"
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost,
                     letters, hashlib.sha256("\n".join(parts).encode()).hexdigest())
    return out


_DIGEST_COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _digests(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in _DIGEST_COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op11_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = _digests(QUERIES["op11_conversation_repair"](spark, sf))
    assert got == _expected_digests(rows)
    assert sum(g[2] for g in got.values()) and sum(g[0] for g in got.values())


def test_op11_nulls_ties_repeats_long_texts_and_extra_columns(spark):
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 1, "user", "x."), (7, None, "user", "x."), (7, None, "user", "x."),
            (8, 1, "user", " \n"), (9, 1, "assistant", "word " * 200_000 + ".")]
    rows += [(rng.randint(0, 30), rng.choice([None, *range(6)]), rng.choice(["system", "user", "assistant", "", None, "Xtool"]),
              rng.choice(["Ja.", "é!", "no", "", " ", "so?\t", None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("clash") for c in ("step", "edit", "fault", "copy", "audit", "cost", "weird.name")})
    got = _digests(conversation_repair.digest(conversation_repair.edits(conversation_repair.damage(df)), df))
    assert got == _expected_digests(rows)
    empty = df.filter("false")
    assert conversation_repair.digest(conversation_repair.edits(empty), empty).count() == 0


def test_repaired_conversations_are_legal_and_repairing_again_changes_nothing(spark):
    convs = spark.read.parquet(f"{SF}/conversations.parquet")
    fixed = conversation_repair.repaired(conversation_repair.edits(conversation_repair.damage(convs))).cache()
    for r in fixed.groupBy("conv_id").agg(
            F.array_sort(F.collect_list(F.struct("position", "role"))).alias("p")).collect():
        assert re.fullmatch("(s?(ua)+)?", "".join(x["role"][0] for x in r["p"]))
        assert [x["position"] for x in r["p"]] == list(range(len(r["p"])))
    whole = fixed.groupBy("conv_id").agg(F.min(F.col("text").rlike(r"[.!?]\s*$")).alias("whole")).filter("whole")
    again = conversation_repair.edits(fixed.join(whole, "conv_id", "left_semi").withColumnRenamed("position", "turn"))
    assert whole.count() > 0 and again.filter("edit != 'K'").count() == 0


# -- op12 -----------------------------------------------------------------
def _mined(rows, anchors, positives=5, negatives=10):
    """rows: (id, label, vector or None)."""
    whole = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows
             if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    last = 1 << 70
    for i, lab, v in whole:
        if i is None or not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), last if j is None else j, other)
                        for j, other, w in whole if j != i)
        for s, j, other in [x for x in scored if x[2] == lab][:positives]:
            fit = [x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(i, None if j == last else j, r, None if k == last else k, -s, -t)
                    for r, (t, k, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


SMALL = hard_negatives.Settings(sample_rows=60, fanout=3, leaf_rows=10, block_rows=7, block_anchors=4)


@pytest.mark.parametrize("dims,spread,seed", [(2, 1.0, 0), (3, 0.1, 1), (8, 1.0, 2)])
def test_mining_equals_brute_force(spark, dims, spread, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = [(int(i), int(rng.integers(0, 3)), (centres[rng.integers(0, 5)] + spread * rng.normal(size=dims)).tolist())
            for i in range(240)]
    rows += [(1000 + i, i % 3, rows[5][2]) for i in range(60)]           # one large group of copies
    rows += [(5, 1, rows[5][2]), (5, 1, rows[5][2]), (None, 0, rows[8][2]), (None, 2, rows[9][2]),
             (2000, None, rows[1][2]), (2001, 1, None), (2002, 1, [None] * dims), (2003, 1, [float("nan")] * dims),
             (2004, 2, [float("inf")] * dims), (2010, 1, []), (2020, 1, [0.5]), (2030, 0, [0.0] * dims)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {c: F.lit("clash") for c in ("id", "v", "leaf", "anchor", "rank", "weird.name")}).repartition(5)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, settings=SMALL)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _mined(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.filter("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_ranges_eliminate_subtrees_but_no_row_of_the_window():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * (rng.normal(size=(8, 4))[rng.integers(0, 8, 3000)] + 0.05 * rng.normal(size=(3000, 4)))).astype(np.int64)
    tree = hard_negatives.Tree(rows[:300], float((rows.astype(float) ** 2).sum(axis=1).max()), 4, 10)
    ranges = {}

    def met(at, far, nearest):
        for j in np.unique(nearest):
            for i in range(far.shape[1]):
                part = far[nearest == j, i]
                low, high = ranges.get((at, i, j), (np.inf, -np.inf))
                ranges[at, i, j] = (min(low, part.min()), max(high, part.max()))

    leaf = tree.route(rows, met)
    tree.set_ranges((*k, *v) for k, v in ranges.items())
    scores = rows[:100] @ rows.T
    best = np.sort(scores, axis=1)
    low, high = (best[:, -200] * 0.9).astype(np.int64), best[:, -200]
    meet = tree.leaves_of(rows[:100], low, high)
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    assert all(meet[a, leaf[r]] for a, r in zip(*np.nonzero(inside)))
    assert meet.mean() < 0.7
    assert not tree.leaves_of(rows[:5], np.full(5, 2), np.full(5, 1)).any()


def test_products_are_exact_for_large_numbers():
    rng = np.random.default_rng(1)
    a = rng.integers(-2 ** 27, 2 ** 27, size=(5, 7))
    assert (hard_negatives.products(a, a) == np.array([[sum(int(x) * int(y) for x, y in zip(p, q)) for q in a] for p in a])).all()


# -- op13 -----------------------------------------------------------------
def _one_by_one(lengths, capacity):
    """Best-fit decreasing with a sorted list of open sequences: how many it opens."""
    open_, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = next((i for i, room in enumerate(open_) if room >= length), None)
        room = open_.pop(at) if at is not None else capacity
        n += at is None
        insort(open_, room - length)
    return n


def _check_layout(placed, capacity):
    """placed: (length, sequence, offset)."""
    by = {}
    for length, sequence, offset in placed:
        by.setdefault(sequence, []).append((offset, length))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_runs_pack_as_best_fit_decreasing_does(case):
    capacity, lengths = case
    counts = {x: lengths.count(x) for x in set(lengths)}
    runs = packing.best_fit_decreasing(counts, capacity)
    if not lengths:
        assert runs.sequences == 0
        return
    length = np.repeat(list(counts), list(counts.values()))
    number = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = runs.find(length, number)
    used = _check_layout(zip(length.tolist(), sequence.tolist(), offset.tolist()), capacity)
    assert used == runs.sequences == _one_by_one(lengths, capacity)


def test_runs_stay_few_for_many_documents():
    rng = np.random.default_rng(0)
    lengths = np.minimum(4096, np.exp(rng.normal(5.5, 1.2, 2_000_000)).astype(int) + 1)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    runs = packing.best_fit_decreasing(counts, 4096)
    assert len(runs.length) < 60_000
    assert runs.sequences <= -(-int(lengths.sum()) // 4096) * 1.001


@functools.cache
def _vocabulary():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())


def _token_ids(texts):
    return [_vocabulary()[0].encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40), st.lists(st.sampled_from([" ", "  ", "\n", "\t", " ", "́", "é", "é", "'s", "<|endoftext|>",
                                                      "ΑΣ ", "don't", "3.14", "İ", "Dans,", "A.B.", "ß!", "I,", "<|endoftext|>.", "<|STARTOFTEXT|>x!", "x²,", "Σ;", "½.", " ", "日本", "ﬁ", "\x1c"]), max_size=12))
def test_words_give_the_ids_of_the_whole_text(text, parts):
    words = _vocabulary()[1]
    for whole in (text, "".join(parts), text.join(parts)):
        assert np.frombuffer(next(words.of([whole])), "<u4").tolist() + [1] == _token_ids([whole])[0]


def test_long_texts_are_tokenised_in_stretches(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 50)
    text = " ".join(f"word{i % 97} " + "x" * (i % 130) for i in range(300))
    monkeypatch.setattr(packing, "_CACHED_WORDS", 40)
    words = packing.WordIds(tokenizer_path())
    texts = [text, None, "", " ", text[:77], text * 2]
    got = [np.frombuffer(ids, "<u4").tolist() + [1] for ids in words.of(texts)]
    assert got == _token_ids(texts)


def test_op13_equals_the_tokenizer_and_packs_tightly(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op13_best_fit_packing"](spark, SF).collect()
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    want, lengths = {}, []
    for doc, ids in zip(docs, _token_ids([d["text"] for d in docs])):
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], dtype="<u4").tobytes()
            want[doc["doc_id"], piece] = (at, len(part) // 4, zlib.crc32(part))
            lengths.append(len(part) // 4)
    assert got == want and len(rows) == len(want)
    assert _check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in rows], 4096) == _one_by_one(lengths, 4096)


def test_op13_edges_and_whole_sequences(spark):
    rows = [(None, None), (None, "one two three"), (1, ""), (1, ""), (2, "one two three"), (2, "one two three"),
            (3, "longer text " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("piece", "ids", "length", "task", "number", "weird.name")}).repartition(3)
    pieces = packing.tokenise(df, tokenizer_path(), capacity=8)
    placed = packing.place(pieces, capacity=8)
    found = placed.collect()
    ids = _token_ids([t for _, t in rows])
    lengths = [len(x[at:at + 8]) for x in ids for at in range(0, len(x), 8)]
    assert sorted(r["length"] for r in found) == sorted(lengths)
    assert _check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in found], 8) == _one_by_one(lengths, 8)
    whole = packing.sequences(pieces, placed).collect()
    assert sorted(x for r in whole for x in np.frombuffer(r["ids"], "<u4").tolist()) == sorted(x for i in ids for x in i)
    by = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in whole}
    for r in pieces.join(placed.drop("doc_id", "piece", "start"), ["task", "length", "number"]).collect():
        part = np.frombuffer(r["ids"], "<u4").tolist()
        assert by[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == part
    assert placed.schema["doc_id"].dataType.simpleString() == "bigint"
    empty = packing.place(packing.tokenise(df.filter("false"), tokenizer_path(), capacity=8), capacity=8)
    assert empty.count() == 0
