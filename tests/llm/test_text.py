"""Tokens, splitting, packing and leaks."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.leaks import WORD_BYTES, Items, leaked_words, leaks, plain, spans, word_hashes
from tessera.llm.packing import pack_documents, places, plan, solve
from tessera.llm.splitting import PARAGRAPH, RangeMaximum, cut_points, split_documents, strengths
from tessera.llm.tokens import PATTERN, tokenized


def tokens(text):
    return [m.start() for m in PATTERN.finditer(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'stremvlld  \n\t.!é1२　’-\x1c\x85𝒳́"), max_size=30), max_size=6))
def test_tokens_equal_the_pattern(texts):
    got = []
    for i, j, _, borders, at, token in tokenized(texts):
        got += [(at[token[k] : token[k + 1]] - borders[k]).tolist() for k in range(j - i)]
    assert got == [tokens(t) for t in texts]


def test_range_maximum():
    v = np.array([random.Random(1).randrange(100) for _ in range(200)])
    table = RangeMaximum(v, 64)
    low = np.array([random.Random(i).randrange(130) for i in range(300)])
    high = low + np.array([random.Random(-i).randrange(64) for i in range(300)])
    assert table(low, high).tolist() == [v[a : b + 1].max() for a, b in zip(low, high)]


def brute_cuts(strength, n, limit, overlap, least):
    out, s = [], 0
    while n - s > limit:
        window = range(s + least, s + limit + 1)
        best = max(window, key=lambda c: (strength[c], c))
        if strength[best] == 0:
            wide = max(range(s + overlap + 1, s + limit + 1), key=lambda c: (strength[c], c))
            best = wide if strength[wide] else best
        out.append((s, best))
        s = best - overlap
    return [*out, (s, n)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=200), st.integers(4, 30), st.data())
def test_cuts_against_brute_force(strength, limit, data):
    overlap = data.draw(st.integers(0, limit // 3))
    least = data.draw(st.integers(overlap + 1, limit))
    n = len(strength)
    d, a, b = cut_points(np.append(np.array(strength, np.int64), 0), np.array([0]), np.array([n]), limit, overlap, least)
    assert list(zip(a.tolist(), b.tolist())) == brute_cuts([*strength, 0], n, limit, overlap, least)


def test_strengths():
    text = "Cím 12. szám. Új mondat!\n- elem\n\nBekezdés"
    for _, _, cp, borders, at, _ in tokenized([text]):
        s = {text[a:][:6]: int(v) for a, v in zip(at, strengths(cp, borders, at))}
    assert s[" szám."] == 1 and s[" Új mo"] == 2 and s["- elem"] == 3 and s["Bekezd"] == PARAGRAPH


DOCS = [(1, None), (2, ""), (3, "szó " * 2000), (4, "x"), (5, ("Egy mondat itt. " * 40 + "\n\n") * 12), (6, "á" * 30000), (5, ("Egy mondat itt. " * 40 + "\n\n") * 12), (None, "a b"), (7, "!?" * 3000)]


def docs(spark, rows=DOCS):
    return spark.createDataFrame([(a, b, "t", 1) for a, b in rows], "doc_id long, text string, piece string, n_tokens long")


def test_split_documents(spark):
    got = split_documents(docs(spark), limit=128, overlap=16, oversized_only=False).collect()
    texts = dict(DOCS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        t = texts[r.doc_id] or ""
        assert r.token_end - r.token_start <= 128 and r.piece == t[r.char_start : r.char_end] and r.n_tokens == len(tokens(t))
    assert set(by) == set(texts)
    for k, rs in by.items():
        rs.sort(key=lambda r: r.piece_no)
        if k == 5:
            assert all(rs[i].piece_no == rs[i + 1].piece_no for i in range(0, len(rs), 2))
            rs = rs[::2]
        assert [r.piece_no for r in rs] == list(range(len(rs))) and rs[0].char_start == 0 and rs[-1].char_end == len(texts[k] or "")
        assert all(b.token_start == a.token_end - 16 for a, b in zip(rs, rs[1:]))
    assert {r.doc_id for r in split_documents(docs(spark), limit=128, overlap=16, with_text=False).collect()} == {k for k, t in texts.items() if len(tokens(t or "")) > 128}
    assert split_documents(docs(spark, []), limit=128, overlap=16).count() == 0
    with pytest.raises(ValueError):
        split_documents(docs(spark), limit=10, overlap=10)


def test_cuts_by_strength(spark):
    sentence = "Egy rövid mondat áll itt. "
    texts = {1: (sentence * 5 + "\n\n") * 60, 2: (sentence * 5 + "\n") * 60, 3: sentence * 300, 4: "szó " * 2000, 5: "a1" * 3000, 6: (sentence * 33 + "\n\n") + sentence * 200}
    before = {}
    for r in split_documents(docs(spark, list(texts.items())), limit=128, overlap=16).collect():
        t = texts[r.doc_id]
        if r.char_end < len(t):
            end = t[: r.char_end]
            kind = "paragraph" if t[r.char_end - 2 : r.char_end] == "\n\n" else "line" if end.endswith("\n") else "sentence" if end.rstrip().endswith(".") else "word" if t[r.char_end] == " " or end.endswith(" ") else "none"
            before.setdefault(r.doc_id, []).append(kind)
    assert {k: set(v) for k, v in before.items()} == {1: {"paragraph"}, 2: {"line"}, 3: {"sentence"}, 4: {"word"}, 5: {"none"}, 6: {"paragraph", "sentence"}}
    assert before[6].count("paragraph") == 1


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_holds_everything_once(hist):
    sizes = np.array(sorted(hist), np.int64)
    fillings = plan(sizes, np.array([hist[s] for s in sizes.tolist()], np.int64), 64, 200)
    held = {}
    for content, times in fillings:
        assert sum(s * n for s, n in content.items()) <= 64
        for s, n in content.items():
            held[s] = held.get(s, 0) + n * times
    assert held == hist
    _, bins = places(fillings)
    need = -(-sum(s * n for s, n in hist.items()) // 64)
    free = []  # first fit, longest first
    for s in sorted(hist, reverse=True):
        for _ in range(hist[s]):
            k = next((k for k, f in enumerate(free) if f >= s), None)
            if k is None:
                free.append(64 - s)
            else:
                free[k] -= s
    assert need <= bins <= len(free) + 1


def test_program_comes_near_the_bound():
    r = random.Random(8)
    sizes = sorted(r.sample(range(20, 2049), 600))
    for times in (1, 50):
        demand = np.array([times * max(1, int(20 / (1 + k / 40))) for k in range(600)], np.int64)
        lengths = np.array(sizes, np.int64)
        solved = solve(lengths, demand, 2048)
        met = sum(a * x for a, x in solved)
        assert np.allclose(met, demand)
        assert sum(x for _, x in solved) <= 1.01 * (lengths * demand).sum() / 2048


@pytest.mark.parametrize("group", [1 << 20, 3])
def test_pack_documents(spark, group):
    got = pack_documents(docs(spark), capacity=256, group=group).collect()
    texts = dict(DOCS)
    used, held = {}, {}
    for r in got:
        n = r.token_end - r.token_start
        held.setdefault(r.doc_id, []).append((r.token_start, r.token_end, r.char_start, r.char_end))
        if n:
            used.setdefault(r.sequence_id, []).append((r.sequence_offset, n))
    for places_ in used.values():
        places_.sort()
        end = 0
        for offset, n in places_:
            assert offset == end
            end += n
        assert end <= 256
    for k, t in texts.items():
        parts = sorted(held[k]) if k != 5 else sorted(held[k])[::2]
        assert "".join((t or "")[c:d] for _, _, c, d in parts) == (t or "")
        assert parts[-1][1] == len(tokens(t or ""))
        assert len(parts) == max(1, -(-len(tokens(t or "")) // 256))
    total = sum(n for p in used.values() for _, n in p)
    assert len(used) <= total / 256 + 2
    assert pack_documents(docs(spark, []), capacity=256).count() == 0
    assert pack_documents(docs(spark, [(1, ""), (2, None)]), capacity=256).count() == 2


WORDS = [f"w{a}{b}" for a in "bcdfghjkmnp" for b in "aouxyzqrt"]


def prose(seed, n):
    r = random.Random(seed)
    return [r.choice(WORDS) + str(r.randrange(7)) for _ in range(n)]


def leak_docs(item, standing):
    own = item[:60]
    half = prose(9, 40)
    changed = [w if i % 12 else "zzz" for i, w in enumerate(own)]
    shuffled = own[:]
    random.Random(3).shuffle(shuffled)
    yield "exact", prose(1, 50) + own[:30] + prose(2, 50), True
    yield "short", prose(1, 50) + own[:18] + prose(2, 50), False
    yield "changed", prose(3, 50) + changed + prose(4, 20), True
    yield "two", own[5:25] + half + own[25:45], True
    yield "order", prose(5, 10) + shuffled, False
    yield "none", prose(6, 200), False
    yield "standing", prose(7, 10) + standing, False


def test_leaks(spark):
    standing = prose(77, 40)
    item = prose(42, 60) + standing
    rows, want = [], set()
    for i, (name, words, hit) in enumerate(leak_docs(item, standing)):
        rows.append((i, " ".join(words)))
        want |= {(i, 7)} if hit else set()
    shown = " ".join(item[:40])
    forms = [shown.upper(), "> " + "\n> ".join(item[:40]), shown.replace("w", "\\u0077"), ", ".join(item[:40]) + "!", "<p>" + "</p> <b>".join(item[:40]), shown.replace("w", "ｗ")]
    for k, t in enumerate(forms):
        rows.append((100 + k, t))
        want.add((100 + k, 7))
    rows += [(500 + k, " ".join(prose(1000 + k, 30) + standing)) for k in range(30)] + [(1, None), (2, ""), (None, shown), (0, rows[0][1])]
    d = spark.createDataFrame([(a, b, "x", 0) for a, b in rows], "doc_id long, text string, item string, words int")
    b = spark.createDataFrame([(7, " ".join(item), "x"), (8, None, "x"), (9, "", "x"), (7, " ".join(item), "x")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in leaks(d, b, standing_least=20).collect()}
    assert got == want
    assert {(r.doc_id, r.item_id) for r in leaks(d, b, index_bytes=72 * 120, standing_least=20).collect()} == want
    whole = lambda **kw: {tuple(r) for r in leaks(d, b, standing_least=20, **kw).collect()}
    assert whole() == whole(most_passes=0)
    assert leaks(d.limit(0), b, most_passes=0).count() == 0
    assert leaks(d.limit(0), b).count() == 0 and leaks(d, b.limit(0)).count() == 0


def test_index_stays_within_its_bytes():
    texts = [" ".join(prose(k, 80)) for k in range(3000)]
    words = sum(len(x.split()) for x in texts)
    index = Items(list(range(3000)), texts)
    assert len(index.hashes) == words and index.nbytes() <= WORD_BYTES * words


def test_leaks_of_many_items(spark):
    # 50,000 items take several passes; what the driver and the workers hold does not grow with them.
    from pyspark.sql import functions as F

    letters = [F.chr(F.lit(97) + F.pmod(F.xxhash64("item_id", F.col("k"), F.lit(i)), F.lit(26)).cast("int")) for i in range(6)]
    words = spark.range(50_000).withColumnRenamed("id", "item_id").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(60))))
    items = words.groupBy("item_id").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("k", F.concat(*letters).alias("w")))), lambda x: x["w"])).alias("text"))
    shown = items.where("item_id % 5000 = 77").select((F.col("item_id") + 1).alias("doc_id"), F.concat(F.lit("before "), F.substring_index("text", " ", 40), F.lit(" after")).alias("text"))
    docs_ = shown.unionByName(items.where("item_id % 5000 = 78").select(F.lit(0).cast("long").alias("doc_id"), F.substring_index("text", " ", 20).alias("text")))
    got = {(r.doc_id, r.item_id) for r in leaks(docs_, items, standing_least=100).collect()}
    assert got == {(5000 * k + 78, 5000 * k + 77) for k in range(10)}


def test_copies_do_not_make_standing_text(spark):
    item, standing = prose(42, 60), prose(77, 40)
    leak = lambda k: " ".join(prose(k, 30) + item[5:45] + prose(k + 1, 30))
    rows = [(i, leak(1)) for i in range(60)] + [(60 + i, leak(1).upper()) for i in range(40)] + [(200, leak(300)), (201, leak(400))]
    rows += [(300 + k, " ".join(prose(1000 + k, 30) + (standing if k < 20 else [])) ) for k in range(200)] + [(500, ""), (501, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(item + standing))], "item_id long, text string")
    want = {(i, 7) for i in [*range(100), 200, 201]}
    assert {(r.doc_id, r.item_id) for r in leaks(d, b).collect()} == want
    # 20 of the 202 different texts carry it; of the 302 rows they would be less than the share.
    assert {(r.doc_id, r.item_id) for r in leaks(d, b, standing_share=0.09).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leaks(d, b, most_passes=0).collect()} == want
    assert spans([3, 0, 40], [20, 15, 15]) == ([0, 40], [23, 55]) and spans([0], [5]) == ([], [])


def test_presentation():
    same = ["Őszi cím, 12. szám", "ŐSZI CÍM 12 SZÁM", "őszi\ncím-\n12 szám", "\\u0151szi c&iacute;m <b>12</b> szám", "oszi cim 12 szam", "ő­szi cí-\nm 12 szám"]
    hashes = [word_hashes([t])[0].tolist() for t in same]
    assert hashes[0] == hashes[1] == hashes[3] == hashes[4] == hashes[5]
    assert plain("a\0b") == "a b" and word_hashes([""])[0].size == 0 and word_hashes(["", "x", ""])[1].tolist() == [0, 0, 1, 1]


def test_leaked_words():
    assert leaked_words([0], [10], [30], set()) == (30, 0)
    assert leaked_words([0, 16], [10, 26], [15, 14], set()) == (30, 1)
    assert leaked_words([0, 15], [10, 200], [15, 15], set()) == (30, 0)
    assert leaked_words([15, 0], [10, 200], [15, 15], set())[0] == 15
    assert leaked_words([0], [10], [30], set(range(10, 30))) == (10, 0)
    assert leaked_words([], [], [], set()) == (0, 0)


def brute_words(runs, standing, bridge=3):
    """Every chain of runs without standing words, none dropped."""
    best = (0, 0)
    runs = sorted(runs)
    chains = [(i, i + n, d + n, 0, 1, i, 0, k) for k, (i, d, n) in enumerate(runs)]
    while chains:
        first, end, place, changes, pieces, begin, need, k = chains.pop()
        words = end - first
        if end - begin >= need and not (pieces == 2 and changes and words < 40) and changes <= words / (10 if words < 50 else 8):
            best = max(best, (words, changes), key=lambda b: (b[0] - b[1], b[0]))
        for m in range(k + 1, len(runs)):
            i, d, n = runs[m]
            over = max(end - i, place - d, 0)
            gap = i + over - end
            cost = max(gap, d + over - place)
            least = 15 if gap else 8
            if over >= n or gap > bridge or any(end + g in standing for g in range(gap)):
                continue
            if cost <= bridge:
                chains.append((first, i + n, d + n, changes + cost, pieces, begin, need, m))
            elif pieces == 1 and end - begin >= least:
                chains.append((first, i + n, d + n, changes + gap, 2, i + over, least, m))
    return best


def random_runs(r, standing):
    """Runs of a few diagonals; two runs of one diagonal never touch."""
    runs = []
    for diagonal in r.sample(range(-3, 60), r.randint(1, 4)):
        i = r.randint(0, 20)
        while i < 70 and len(runs) < 14:
            n = r.randint(2, 25)
            if not standing & set(range(i, i + n)):
                runs.append((i, i + diagonal + 3, n))
            i += n + r.choice((1, 1, 2, 3, 9))
    return runs


def test_leaked_words_against_brute_force():
    for seed in range(1500):
        r = random.Random(seed)
        standing = set(r.sample(range(90), r.choice((0, 0, 3))))
        runs = random_runs(r, standing)
        assert leaked_words(*(list(x) for x in zip(*runs)), standing) == brute_words(runs, standing) if runs else True, (seed, runs, standing)


def test_leaked_words_among_many_runs():
    # A leak of 44 words in two pieces with a change, and a mould sentence of the item repeated 400 times between them.
    mould = [(5 + k % 12, 1000 + 31 * k, 9) for k in range(400)]
    leak = [(0, 10, 20), (21, 31, 9), (30, 90000, 14)]
    assert leaked_words(*(list(x) for x in zip(*leak)), set()) == (44, 1)
    assert leaked_words(*(list(x) for x in zip(*leak, *mould)), set()) == (44, 1)
