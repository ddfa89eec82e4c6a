"""Conversation repair, spelling variants and nearest vectors against brute force and edge cases."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimrisk.llm import multiindex, passages, repair, variants

# -- conversations

CONVERSATION = "conv_id long, turn long, role string, text string, row string, digest string, kind int"


def slow_repair(rows):
    """Damage, faults and the cheapest, ASCII-least edits by a best-first search over whole conversations."""
    after = defaultdict(list)
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if k == 1 else "".join(ch for ch in x if ch not in ".!?") if k == 2 else x
        after[c] += [(t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return {c: _slow_one(after[c]) for c in {r[0] for r in rows}}


def _next(state, initial):
    return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)


def _slow_one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, r, x in rows:
        solid = x.strip(" \t\n\v\f\r")
        faults.append("b" if not solid else "d" if (r, x) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((r, x))
    turns = [r[0] for r in rows if r[0] is not None]
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        named = [(n, to) for n in ("user", "assistant") if (to := _next(state, n[0]))]
        for n, to in named:
            heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*out, f"{n}:")))
        if i < len(rows):
            _, r, x = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, out))
            if faults[i] in ("", "t"):
                more = cost + (5 if faults[i] else 0)
                if r[:1] and (to := _next(state, r[:1])):
                    heapq.heappush(heap, (more, audit + "K", i + 1, to, (*out, f"{r}:{x}")))
                for n, to in named:
                    heapq.heappush(heap, (more + 1, audit + "R", i + 1, to, (*out, f"{n}:{x}")))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def odd_conversations(n, seed):
    r = random.Random(seed)
    return [(r.choice([None, 1, 1, 1, 2, 3, 4]), r.choice([None, *range(150)]),
             r.choice(["user", "assistant", "system", "tool", None, "", "sys", "User"]),
             r.choice(["a.", "b", "", "  ", "c!", None, "d? ", "e\n", "f" * 3000, "g.\t"])) for _ in range(n)]


@pytest.mark.parametrize("chunk", [4, 60, 10_000])
def test_repair_matches_a_search(spark, chunk):
    rows = odd_conversations(300, 4)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], CONVERSATION).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(spark, df, chunk).collect()}
    assert got == slow_repair(rows)


def test_repair_of_the_given_conversations(spark, root):
    table = spark.read.parquet(f"{root}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(spark, table, 5).collect()}
    assert got == slow_repair(rows)
    assert repair.repair(spark, table.where("false")).count() == 0


def test_a_conversation_all_of_whose_rows_are_dropped(spark):
    lost = next((c, t) for c in range(100) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*lost, "user", "x.")], "conv_id long, turn long, role string, text string")
    assert tuple(repair.repair(spark, df).first()) == (
        lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_fix_up_passes_end_with_the_exact_vectors():
    r = random.Random(2)
    for _ in range(300):
        symbols = "".join(r.choice("suaSUA-_x") for _ in range(r.randint(1, 60)))
        cut = r.randint(0, len(symbols))
        search = repair.Search()
        whole, cost = search.backward(symbols, repair.LAST)
        tail, back = search.backward(symbols[cut:], repair.LAST)
        head, offset = search.backward(symbols[:cut], repair.SPECULATIVE)
        head, offset = search.fixed(symbols[:cut], repair.SPECULATIVE, head, offset, tail)
        assert (head, offset + back) == (whole, cost)


# -- spelling variants


def slow_variants(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            k = h % len(low)
            counts[low[:k] + low[k + 1:] if h % 199 == 0 else low] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def spellings():
    """Words in chains of ever rarer variants, anagrams, accents, one very long run, nulls and repeated rows."""
    r = random.Random(6)
    base = ["".join(r.choice("aeilnrstéß×") for _ in range(r.randint(6, 9))) for _ in range(40)]
    words = []
    for w in base:
        words += [w] * 700
        for times in (130, 25, 5):
            k = r.randrange(len(w))
            w = r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("xyz") + w[k:], w[:k] + "q" + w[k + 1:]])
            words += [w] * times
    words += ["".join(r.sample("abcdef", 6)) for _ in range(4000)] + ["Straße", "STRASSE"] * 9
    words += ["ÉTÉÉTÉ", "étéété"] * 6
    r.shuffle(words)
    docs = [(i, " ".join(words[i::50])) for i in range(50)] + [(60, None), (61, ""), (62, "1 2 . 中"), (None, "abcdefg " * 7)]
    long = "z" * 30_000
    docs += [(70 + i, f"{long} {long}y {'ab' * 9000}") for i in range(6)] + [(5, docs[5][1])]
    return docs


@pytest.mark.parametrize("subtree", [20_000, 30])
def test_variants_match_brute_force(spark, subtree, monkeypatch):
    monkeypatch.setattr(variants, "VISITORS", 64 if subtree == 30 else 2048)
    monkeypatch.setattr(variants, "FRONTIER", 500 if subtree == 30 else 400_000)
    docs = spellings()
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs],
                               "doc_id long, text string, word string, n long, tree string").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.grouped(spark, df, subtree).collect()}
    want = slow_variants(docs)
    assert got == want
    assert sum(f is not None and f != root for f, root, *_ in want.values()) > 5  # chains
    assert variants.grouped(spark, df.where("false")).count() == 0


def test_the_trie_meets_all_words_one_edit_away():
    r = random.Random(1)
    words = list({"".join(r.choice("abcde") for _ in range(7)) for _ in range(300)})
    trie = variants.Trie(words, np.ones(len(words), np.int64))
    for length in (7, 8):
        asked = list({"".join(r.choice("abcde") for _ in range(length)) for _ in range(200)})
        letters = variants.letters_of(asked, length)
        got = set()
        for v, h in trie.candidates(variants.vectors(letters), int(length > 7)):
            near = trie.near(letters, v, h)
            got |= {(asked[a], trie.words[b]) for a, b in zip(v[near], h[near])}
        want = {(a, b) for a in asked for b in words if (
            sum(x != y for x, y in zip(a, b)) == 1 if length == 7 else any(a[:i] + a[i + 1:] == b for i in range(8)))}
        assert got == want


# -- nearest vectors

VECTORS = "vec_id long, embedding array<double>, label int, cell int, score double"


def slow_nearest(rows, every=20, k=20):
    width = max((len(v) for _, v in rows), default=0)
    good = {(i, tuple(map(float, v)) + (0.0,) * (width - len(v))) for i, v in rows}
    out = {}
    for i, v in good:
        if i % every == 0:
            scored = []
            for j, w in good:
                if j != i:
                    s = 0.0
                    for a, b in zip(v, w):
                        s += a * b
                    scored.append((-s, j))
            out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def odd_vectors():
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] * r.uniform(0.2, 3) + r.normal(size=12) * 0.3).round(2).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]                       # a very common vector
    rows += [(2000 + i, (np.array(rows[40][1]) * -1).tolist()) for i in range(30)]
    rows += [(3000, [1.0, 2.0]), rows[20], rows[20]]                           # short, repeated
    bad = [(4000, None), (4020, [0.0] * 12), (4040, [float("nan")] * 12), (4060, [float("inf")] + [0.0] * 11),
           (4080, [None] + [1.0] * 11), (None, [1.0] * 12), (4100, [])]
    return rows, bad


def test_nearest_with_everything_in_reach_is_exact(spark, monkeypatch):
    rows, bad = odd_vectors()
    monkeypatch.setattr(multiindex, "LEAST_BLOCK", 7)
    monkeypatch.setattr(multiindex, "PAIRS", 50)
    df = spark.createDataFrame([(*r, 1, 2, 3.0) for r in rows + bad], VECTORS).repartition(3)
    got = defaultdict(list)
    for r in multiindex.nearest(spark, df, target=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = slow_nearest(rows)
    exact = 0
    for i, found in want.items():
        assert [x[0] for x in got[i]] == list(range(1, 21))
        assert [(j, s) for _, j, s in got[i]] == sorted([(j, s) for _, j, s in got[i]], key=lambda x: (-x[1], x[0]))
        exact += sum(x in found for x in [(j, s) for _, j, s in got[i]])
    assert set(got) == set(want) and exact > 0.97 * 20 * len(want)


def test_recall_is_measured_and_kept(spark):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=8) + 4 * np.eye(8)[i % 8]).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = multiindex.built(spark, df, 20, 20, 0.95)[2]
    assert index.recall >= 0.95 and index.budget < 3000
    got = defaultdict(set)
    for x in multiindex.nearest(spark, df).collect():
        got[x.query_id].add(x.vec_id)
    want = slow_nearest(rows)
    found = np.mean([len(got[i] & {j for j, _ in near}) / 20 for i, near in want.items()])
    assert found >= 0.9


def test_fewer_vectors_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in multiindex.nearest(spark, df).orderBy("rank").collect()] == [
        (0, 1, 1, 1.0), (0, 2, 2, -1.0)]
    assert multiindex.nearest(spark, df.where("false")).count() == 0
    assert multiindex.nearest(spark, df.where("vec_id = 0")).count() == 0


def test_cells_are_walked_by_growing_distance():
    r = np.random.default_rng(9)
    for _ in range(50):
        x, y = r.random(6), r.random(5)
        counts = r.integers(0, 4, 30)
        budget = int(r.integers(1, counts.sum() + 1))
        order = sorted((x[i] + y[j], i * 5 + j) for i in range(6) for j in range(5))
        held, limit = 0, None
        for d, cell in order:
            held += counts[cell]
            if held >= budget:
                limit = d
                break
        assert multiindex.reach(x, y, counts.tolist(), budget) == pytest.approx(limit)


def test_contexts_that_many_documents_hold_are_compared():
    """All pairs that share enough tokens, also where more documents than a few hold every one of them."""
    rng = np.random.default_rng(5)
    line, passage = np.arange(30), np.arange(100, 140)
    docs, around, enough = [], [], []
    for i in range(150):
        some = [line, rng.integers(1000, 10**6, 50)] + ([rng.permutation(passage)[:39]] if i % 2 else [])
        docs.append(1000 - i)
        around.append(np.unique(np.concatenate(some)).astype(np.uint32))
        enough.append(37 if i % 3 else 36)
    want = {(docs[a], docs[b]) for a in range(150) for b in range(150)
            if docs[b] < docs[a] and len(np.intersect1d(around[a], around[b])) >= max(enough[a], enough[b])}
    assert len(want) == 75 * 74 // 2
    assert sorted(passages.sharing(docs, around, enough)) == sorted(want)
    few = slice(0, passages.FEW)
    assert set(passages.sharing(docs[few], around[few], enough[few])) == {
        (a, b) for a, b in want if b > 1000 - passages.FEW}


def test_a_context_needs_what_its_least_varied_stretch_allows():
    least = 46
    varied = np.arange(300, dtype=np.uint64)
    assert passages.context(varied, 100, least)[1] == 37 and len(passages.context(varied, 100, least)[0]) == 138
    repeated = np.concatenate([varied[:60], np.full(40, 7, np.uint64), varied[100:]])
    around = repeated[54:192]
    fewest = min(len(np.unique(around[i:i + least])) for i in range(len(around) - least + 1))
    assert passages.context(repeated, 100, least)[1] == -(-80 * fewest // 100)


def test_open_keys_pair_every_two_functions():
    tokens = np.random.default_rng(3).integers(1, 2**62, 120).astype(np.uint64)
    own = passages.Stretches(tokens, 46)
    for f, g in ((0, 2), (1, 5), (6, 7)):
        known = np.unique(np.r_[own.hashes[f], own.hashes[g]])
        assert len(passages.open_keys(tokens, 46, known, [])[0]), (f, g)


def test_equal_contexts_of_a_document_and_key_are_one_row(spark):
    """A text that repeats a phrase has its context once a key; the pairs are those of all its stretches."""
    least, phrase = 46, " ".join(f"word{i}" for i in range(7)) + " "
    texts = {i: phrase * (25 + i) + " ".join(f"own{i}x{j}" for j in range(30)) for i in (3, 5, 8)}
    tokens = {i: passages.tokens_of(text)[0] for i, text in texts.items()}
    shared = {i: passages.Stretches(t, least).distinct() for i, t in tokens.items()}
    every = {}
    for i, t in tokens.items():
        for key, start in zip(*passages.open_keys(t, least, shared[i], [])):
            every.setdefault(int(key.view(np.int64)), []).append((i, *passages.context(t, int(start), least)))
    every = {key: rows for key, rows in every.items() if len({i for i, *_ in rows}) > 1}
    own = spark.createDataFrame([(i, text, shared[i].view(np.int64).tolist(), None) for i, text in texts.items()],
                                "doc_id long, text string, shared array<long>, "
                                "spans array<struct<start_word:long,end_word:long>>")
    got = {}
    for r in passages._contexts(spark, own.select("doc_id", "text"), own, least).collect():
        assert r.n == len(every[r.key])
        got.setdefault(r.key, []).append((r.doc_id, np.frombuffer(r.around, np.uint32), r.enough))
    assert set(got) == set(every)
    assert all(len({(i, around.tobytes()) for i, around, _ in rows}) == len(rows) for rows in got.values())
    assert sum(map(len, got.values())) < sum(map(len, every.values()))
    for key in got:
        assert set(passages.sharing(*map(list, zip(*got[key])))) == set(passages.sharing(*map(list, zip(*every[key]))))
