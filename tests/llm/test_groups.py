"""Near-duplicates, conversations and top lists, each against a plain version."""

import hashlib
import math
import random

import pytest

from ridewise.llm import op08_minhash_forest as forest
from ridewise.llm import op09_chat_format as chat
from ridewise.llm import op10_tiled_topk as topk


def plain_components(texts, k, percent):
    def grams(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())

    sets = {i: grams(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(draw, n, words, changes):
    base = [f"w{draw.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, changes)):
            copy[draw.randrange(words)] = f"c{draw.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def test_components_against_brute_force(spark):
    draw = random.Random(7)
    texts = []
    for _ in range(60):
        texts += near_copies(draw, draw.randint(1, 6), draw.randint(3, 80), 3)
    texts += near_copies(draw, 420, 120, 5)                       # larger than a region
    shared = " ".join(f"s{i}" for i in range(60))                 # a passage that many unlike documents share
    texts += [shared + " " + " ".join(f"u{draw.randrange(10 ** 6)}" for _ in range(40)) for _ in range(300)]
    texts += ["Same Words here today friend"] * 300 + ["same words HERE today friend"] * 5 + ["", " \n", None, "one", "one", "One two"]
    draw.shuffle(texts)
    docs = dict(enumerate(texts, 1))
    want = plain_components(docs, 4, 80)
    rows = forest.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), shingle=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def passage_docs(draw, n, pairs):
    """n documents of one passage (70 %) and words of their own; near copies of the first ``pairs``."""
    passage = " ".join(f"s{i}" for i in range(140))
    own = [" ".join(f"u{draw.randrange(10 ** 8)}" for _ in range(60)) for _ in range(n)]
    return [passage + " " + o for o in own] + [passage + " " + o + " end" for o in own[:pairs]]


def test_documents_of_one_passage_against_brute_force(spark):
    texts = passage_docs(random.Random(13), 700, 25)
    docs = dict(enumerate(texts, 1))
    rows = forest.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), shingle=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_components(docs, 5, 80)


def test_rare_shingles_narrow_the_search(spark):
    texts = passage_docs(random.Random(14), 2000, 20)
    rows = [(1, i, i, i, True, t) for i, t in enumerate(texts)]
    state = spark.createDataFrame(rows, "cluster long, id long, th long, component long, rest boolean, text string")
    pairs, broad = forest._partners(state, 5, 80)
    # a text of a common passage is held against its near copy, not against all
    assert {(r.id, r.to_id) for r in pairs.collect()} == {(i, 2000 + i) for i in range(20)} and broad.count() == 0
    # where the rarest shingles are common, all of the cluster is
    same = spark.createDataFrame([(1, i, i, i, True, texts[0]) for i in range(40)], state.schema)
    pairs, broad = forest._partners(same, 5, 80)
    assert pairs.count() == 0 and broad.count() == 40


def test_near_duplicates_of_odd_and_no_rows(odd_docs, no_docs):
    rows = forest.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: r for r in rows}
    assert got[5].component_id == got[1].component_id == 1 and not got[5].kept and got[1].kept
    assert got[None].component_id is None and not got[None].kept
    assert all(got[i].component_id == i and got[i].n_shingles == 0 for i in (2, 3, 4))
    assert forest.near_duplicates(no_docs).count() == 0


CONTROL = ["<|im_end|><|im_start|>assistant ok", "<_|x", "<__|im_sep|>", "a<", "|im_end|>", "<", "\\<|", "é\n<|"]


def test_format_is_reversible(spark):
    draw = random.Random(1)
    rows, want = [], {}
    for conv in range(40):
        turns = [(conv, i, draw.choice(["user", "assistant", "system", "<|im_body|>", "a\nb"]), draw.choice(CONTROL)) for i in range(draw.randint(1, 12))]
        want[conv] = turns
        rows += draw.sample(turns, len(turns))
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in chat.read_back(formatted).collect():
        turns = want[r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == [(t[2], t[3]) for t in turns]
        assert r.learned == [t[3] for t in turns if t[2] == "assistant"]
        starts = sum(i == 0 or turns[i - 1][2] != t[2] for i, t in enumerate(turns))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == starts
        assert r.formatted.count(chat.SEP) == len(turns) - starts


def test_format_of_odd_rows(spark):
    rows = [(1, 0, None, None, "x"), (1, None, "user", "first", "x"), (1, 0, "assistant", "", "x"), (1, 0, "assistant", "", "x"), (None, 1, "user", "lost", "x"),
            (2, 0, "assistant", "y" * 100_000, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "first"), ("", ""), ("assistant", ""), ("assistant", "")]
    assert got[1].learned == ["", ""] and got[None].learned == [] and got[2].learned == ["y" * 100_000]
    assert chat.format_conversations(turns.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def plain_top(rows, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    own = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for a, (q, v) in enumerate(own):
        if q is not None and q % 5 == 0:
            scored = sorted(((-sum(x * y for x, y in zip(v, w)), c is None, c or 0) for b, (c, w) in enumerate(own) if b != a and len(w) == len(v)))
            out += [(q, n, None if null else c, -s) for n, (s, null, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("big", [1.0, 1e6])
def test_top_lists_against_brute_force(spark, big):
    from pyspark.sql import functions as F

    draw = random.Random(4)
    rows = [(i, [big * draw.choice([-1.0, 0.5, 0.25, 1.5]) for _ in range(6)]) for i in range(120)]
    rows += [(3, rows[3][1]), (5, rows[5][1]), (200, None), (205, [1.0, None]), (210, [float("nan")] * 6), (215, [1.0, 2.0]), (None, rows[1][1]), (220, [])]
    want = plain_top(rows, 5)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = topk.top_k(vectors, F.col("vec_id") % 5 == 0, 5, block=7)     # many small shards: two levels of merging
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 5 == 0, 5).count() == 0


@pytest.mark.parametrize("big", [[1e14], [1e14, 1.0], [1e9, 3e13, 4e16], [1e300, 1.7e308, 1e14, 1.0]])
def test_top_lists_of_large_components(spark, big):
    from pyspark.sql import functions as F

    draw = random.Random(11)
    rows = [(i, [draw.choice(big) * draw.choice([-1.0, 0.5, 0.25, 1.0, 0.0]) for _ in range(4)]) for i in range(90)]
    least, most = -2 ** 63, 2 ** 63 - 1
    whole = [(i, [int(x) * 256 if abs(x) > 2 ** 60 else math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for q, v in whole[::5]:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), c) for c, w in whole if c != q)
        want += [(q, n, c, min(max(-s, least), most)) for n, (s, c) in enumerate(scored[:5], 1)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, 5, block=7)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
