"""Prefix trie, decontamination and structure repair, each against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridewise.llm import catalog
from ridewise.llm import op11_prefix_trie as trie
from ridewise.llm import op12_decontaminate as leaks
from ridewise.llm import op13_structure_repair as repair

TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- trie ------------------------------------------------------------------------------

def plain_trie(paths):
    """{path: (conv_id, depth, parent, convs, children, leaves, saved, ends)} of {conv_id: sequence of turns}."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   sha(",".join(str(c) for c in sorted(m) if paths[c] == p))) for p, m in members.items())


def spark_trie(spark, paths, mark=True):
    rows = [(c, i, r, t) for c, path in paths.items() for i, (r, t) in enumerate(path)]
    turns = trie.numbered_turns(spark.createDataFrame(rows, TURNS))
    marks = spark.createDataFrame([(c,) for c in paths], "conv_id long").select(
        "conv_id", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("token"), F.lit(None).cast("int").alias("chars"))
    got = trie.prefix_trie(turns.unionByName(marks)).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got)


def random_paths(draw, n):
    says = [("user", "a"), ("user", "bb"), ("assistant", "ccc"), ("", ""), ("user", "日本")]
    paths = {c: tuple(draw.choice(says) for _ in range(draw.choice([0, 1, 2, 3, 4, 9]))) for c in range(-7, n)}
    hot = (says[0],) * 3
    return paths | {c: hot for c in range(n, 2 * n)} | {c: hot + (("user", str(c)),) for c in range(2 * n, 3 * n)}


@pytest.mark.parametrize("levels", [1 << 14, 40])
def test_trie_against_brute_force(spark, monkeypatch, levels):
    """With few levels a shard: many shards and rounds, spines through a hot prefix and one first turn of many children."""
    monkeypatch.setattr(trie, "SHARD_LEVELS", levels)
    monkeypatch.setattr(trie, "LONGEST_PATHS", 3)
    paths = random_paths(random.Random(5), 150)
    assert spark_trie(spark, paths) == plain_trie(paths)


def test_trie_of_long_and_of_few_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_LEVELS", 10)
    monkeypatch.setattr(trie, "LONGEST_PATHS", 2)
    long = tuple(("user", str(i)) for i in range(400))
    paths = {1: long, 2: long[:399], 3: long + (("user", "x"),), 4: (), 5: long[:7], 6: long}
    assert spark_trie(spark, paths) == plain_trie(paths)
    assert spark_trie(spark, {9: ()}) == plain_trie({9: ()})
    assert trie.prefix_trie(trie.numbered_turns(spark.createDataFrame([], TURNS))).count() == 0


def test_shards_merge_like_one(spark):
    """Every cut of a sorted list of paths into shards gives the tree that one shard gives."""
    draw = random.Random(2)
    says = [bytes([b]) * trie.TOKEN for b in b"abc"]
    for _ in range(60):
        paths = sorted({b"".join(draw.choices(says, k=draw.randint(0, 5))) for _ in range(draw.randint(1, 14))})
        items = [(p, [1] * (len(p) // trie.TOKEN), *([0] * (len(p) // trie.TOKEN) + [v] for v in (draw.randint(1, 4), i, 0, 0, 0)), [None] * (len(p) // trie.TOKEN) + [f"e{i}"])
                 for i, p in enumerate(paths)]
        items = [(p, ch, n, [trie._NONE] * (len(low) - 1) + low[-1:], *rest) for p, ch, n, low, *rest in items]

        def done(shards, whole, keyed):
            rows, nexts = [], []
            for part in shards:
                shard = trie.Shard()
                for item in part:
                    shard.add(*item)
                r, x = shard.close(whole, keyed)
                rows, nexts = rows + r, nexts + x
            return rows, nexts

        want = sorted(r[:2] + r[5:] for r in done([items], True, False)[0])
        cuts = sorted(draw.sample(range(1, len(items)), min(len(items) - 1, draw.randint(0, 4))))
        rows, nexts = done([items[a:b] for a, b in zip([0, *cuts], [*cuts, len(items)])], False, False)
        more, none = done([sorted(nexts, key=lambda i: i[0])], True, True)
        assert not none and sorted(r[:2] + r[5:] for r in rows + more) == want
        keys = {r[4] for r in more}
        assert all(r[3] in keys for r in rows if r[3] is not None)


def test_findclose_against_a_stack():
    draw = random.Random(3)
    for n in (1, 2, 63, 64, 65, 700, 3000):
        bits, open_ = [1], 1
        while len(bits) < n or open_ > 1:
            up = len(bits) < n and (open_ == 1 or draw.random() < 0.55)
            bits.append(int(up))
            open_ += 1 if up else -1
        bits.append(0)
        want, stack = {}, []
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        got = trie.Parentheses(np.array(bits)).findclose()
        assert got.tolist() == [want[i] for i in sorted(want)]


def test_trie_query_with_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows, missing bases, clashing columns."""
    rows = [(100, 0, "user", "a"), (100, None, None, None), (100, 1, "assistant", ""), (101, 0, "user", "b"), (101, 1, "user", "c"), (301, 0, "user", "z"),
            (100, 0, "user", "a"), (None, 0, "user", "q"), (102, 3, "user", "x" * 100_000), (107, None, "user", None), (-1, 0, "user", "n"), (200, 0, "user", "a")]
    rows += [(109, t, "user", str(t)) for t in range(40)]
    spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("x")).withColumn("token", F.lit(1)).write.parquet(str(tmp_path / "conversations.parquet"))
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((r or "", x or ""))

    def rebuilt(c):
        h = zlib.crc32(str(c).encode()) % 6
        return tuple(own.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])[:h] + own[c][h:])

    got = catalog.REGISTRY["op11_prefix_trie"][0](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in got) == plain_trie({c: rebuilt(c) for c in own})


# -- decontamination --------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return [(m[0], m.span()) for m in WORD.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]


def plain_hits(text, items, n):
    found = plain_words(text)
    said = [w for w, _ in found]
    hit, names = set(), set()
    for item, other in items:
        words = [w for w, _ in plain_words(other)]
        k = min(n, len(words))
        windows = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if k else set()
        for i in range(len(said) - k + 1 if k else 0):
            if tuple(said[i:i + k]) in windows:
                hit |= set(range(i, i + k))
                names.add(item)
    spans = []
    for p in sorted(hit):
        if spans and p - 1 in hit and spans[-1][2] == p - 1:
            spans[-1] = (spans[-1][0], found[p][1][1], p)
        else:
            spans.append((*found[p][1], p))
    return len(said), hit, names, [s[:2] for s in spans]


@pytest.mark.parametrize("part", [leaks.AUTOMATON_BYTES, 30])
def test_leaks_against_brute_force(spark, monkeypatch, part):
    """Items of any length, in one automaton and in several."""
    monkeypatch.setattr(leaks, "AUTOMATON_BYTES", part)
    draw = random.Random(4)
    words = ["a", "b", "C", "é", "日本", "7", "d"]
    items = [(i, draw.choice(" .-\n").join(draw.choices(words, k=draw.randint(0, 14)))) for i in range(30)] + [(31, None), (32, " !"), (None, "a a a b b b"), (5, "7 7 7 7 7")]
    docs = [(i, "".join(w + draw.choice([" ", ", ", "\n", " 😀! "]) for w in draw.choices(words, k=draw.randint(0, 60)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "?!"), (103, "x " * 30_000 + items[7][1] + " y" * 30_000), (1, docs[1][1]), (None, items[3][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("hits", "spans", "row", "items")})
    found = leaks.contaminated_spans(frame, spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)), n=4)
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, hit, names, spans = plain_hits(r.row.text, items, 4)
        assert (r.hits.n_words, r.hits.items) == (n, sorted(str(i) for i in names if i is not None))
        assert {p for a, b in zip(r.hits.firsts, r.hits.ends) for p in range(a, b)} == hit and r.hits.nameless == (None in names)
        # an emoji counts as a word here, as any character beyond ASCII
        assert [tuple(s) for s in r.spans] == spans
    clean = {r.doc_id: r.text for r in leaks.cleaned(found).collect()}
    assert clean[100] is None and clean[101] == "" and clean[102] == "?!"
    whole = {i: t for i, t in docs}
    assert all(clean[i] == whole[i] for i in whole if i is not None and not plain_hits(whole[i], items, 4)[1])
    assert leaks.cleaned(found).columns == frame.columns


def test_leaks_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert leaks.contaminated_spans(docs.limit(0), items).count() == 0
    r = leaks.contaminated_spans(docs, items.limit(0)).first()
    assert (r.hits.n_words, r.hits.items, r.spans) == (2, [], [])
    assert leaks.cleaned(leaks.contaminated_spans(docs, items)).first().text == " "


# -- repair -----------------------------------------------------------------------------

def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired) by trying every edit list of each cost, shortest suffixes first."""
    faults = plain_faults(rows)
    memo = {}

    def best(i, state, inserted):
        if (i, state, inserted) in memo:
            return memo[i, state, inserted]
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[nexts]

        def then(cost, edit, said, tail):
            ways.append((cost + tail[0], edit + tail[1], said + tail[2]))

        if inserted < 3:
            then(3, "I", (f"{name}:",), best(i, nexts, inserted + 1))
        if i < len(rows):
            _, role, text = rows[i]
            then(4, "D", (), best(i + 1, state, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                then(3 + more, "R", (f"{name}:{text}",), best(i + 1, nexts, 0))
                if role[:1] == nexts or role[:1] == "s" and state == "":
                    then(more, "K", (f"{role}:{text}",), best(i + 1, role[:1], 0))
        memo[i, state, inserted] = min(ways) if ways else (10 ** 9, "", ())
        return memo[i, state, inserted]

    return best(0, "", 0)


def plain_summary(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    cost, audit, said = plain_repair(rows)
    faults, turns = plain_faults(rows), {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, sha("\n".join(said)))


def random_conversation(draw):
    return [(draw.choice([None, *range(9)]), draw.choice(["user", "user", "assistant", "assistant", "system", "u", "x", ""]),
             draw.choice(["", " \t", "yes.", "no", "why? ", "ok!\n", "a.b", "日本。", "été."])) for _ in range(draw.randint(1, 9))]


def as_rows(found):
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found.collect()}


def test_repair_against_brute_force(spark):
    draw = random.Random(6)
    talks = {c: random_conversation(draw) for c in range(-3, 400)} | {None: random_conversation(draw)}
    rows = [(c, *r) for c, talk in talks.items() for r in talk]
    draw.shuffle(rows)
    turns = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("conv", "pos", "fault", "seen", "step")})
    edits = repair.structure_edits(turns)
    got = as_rows(repair.edit_digests(edits))
    assert got == {("" if c is None else f"={c}"): plain_summary(t) for c, t in talks.items()}
    fixed = {}
    for r in repair.repaired(edits).collect():
        fixed.setdefault(r.conv_id, []).append((r.step, r.role[:1]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(i for _, i in sorted(said))) for said in fixed.values())


def test_repair_of_a_long_conversation(spark, monkeypatch):
    """Longer than a block of pointers, and with batches that end anywhere."""
    draw = random.Random(8)
    talk = [(t, draw.choice(["user", "assistant", "system"]), draw.choice(["one.", "two", f"{t}.", f"{t}"])) for t in range(150)]
    want = plain_summary(talk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    rows = [(1, *r) for r in talk] + [(2, t, "user", f"{t}.") for t in range(80_000)]      # over one block in the tasks
    got = as_rows(repair.edit_digests(repair.structure_edits(spark.createDataFrame(rows, TURNS))))
    assert got["=1"] == want
    assert got["=2"][5] == 240_000 // 2 and set(got["=2"][6]) == {"K", "R"}
    monkeypatch.setattr(repair, "BLOCK", 7)
    marked = repair.faulted(spark.createDataFrame(rows[:150], TURNS)).toPandas().sort_values("pos")
    marked["initial"] = marked["role"].str[:1]
    marked = marked.astype(object).where(marked.notna(), None)

    def batches(frame, n):
        return (frame.iloc[i:i + n] for i in range(0, len(frame), n))

    blocks = [b for b in repair._pointer_blocks(batches(marked.iloc[::-1], 11))]
    blocks = pd.concat(blocks)
    assert len(blocks) == 22 and blocks.pointers.map(len).max() == 7
    both = pd.concat([marked.assign(pointers=None, kind=1), blocks.assign(kind=0)]).sort_values(["pos", "kind"])
    both = both.astype(object).where(both.notna(), None)
    edits = pd.concat(repair._edit_rows(batches(both, 13)))
    assert "".join(edits.edit) == want[6] and edits.cost.sum() == want[5]


def test_repair_query_over_whole_and_no_conversations(spark, tmp_path):
    rows = [(1, 0, "user", "x"), (1, None, None, None), (2, 5, "assistant", "Yes. No"), (3, 1, "user", "a."), (3, 1, "user", "a."), (None, None, None, None)]
    rows += [(c, t, "user", "Go!") for c in range(10, 60) for t in range(3)]
    rows += [(c, 0, "user", "Gone.") for c in range(60, 400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    talks = {}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if kind == 4 else " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        talks.setdefault(c, []).extend([(t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    query = catalog.REGISTRY["op13_structure_repair"][0]
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in query(spark, str(tmp_path)).collect()}
    assert got == {c: plain_summary(t) for c, t in talks.items()}
    assert any(not t for t in talks.values())
    spark.createDataFrame([], TURNS).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    for n in ("op11_prefix_trie", "op13_structure_repair"):
        assert catalog.REGISTRY[n][0](spark, str(tmp_path / "none")).count() == 0
