"""Template decisions against a plain Python walk of the same tree."""

import re
import struct
import time
from collections import Counter, defaultdict
from itertools import combinations

import xxhash

from actuaria.llm import line_templates as L
from tests.llm.helpers import empty_docs, odd_docs, odd_rows, prose, with_extras

BOILER = [f"Posted by user{i} on 2024-01-{i:02d} in topic {w} board" for i, w in enumerate(["news", "chat", "help", "misc", "art"])]


def tokens(line):
    masked = re.sub(r"(?<!\S)\S*[0-9]\S*", L.MASK, line)
    return re.split(r"\s+", masked.strip(" "))


def line_keys(t, depth, similarity):
    """The line without any two of its blocks, where enough of it is left."""
    rest, out = len(t) - depth, []
    blocks = [t[depth + b :: L.BLOCKS] for b in range(L.BLOCKS)]
    for a, b in combinations(range(L.BLOCKS), 2):
        left = rest - len(blocks[a]) - len(blocks[b])
        if left > 0 and left >= similarity * rest:
            out.append((a, b, *(blocks[i] for i in range(L.BLOCKS) if i not in (a, b))))
    return out


def chain(values, seed=42):
    """Spark's xxhash64 of strings, ints (4 bytes), longs (8 bytes, as ("long", x)) and arrays."""
    for v in values:
        if isinstance(v, list):
            seed = chain(v, seed)
        else:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i", v) if isinstance(v, int) else struct.pack("<q", v[1])
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def key_digest(leaf, key):
    a, b, *blocks = key
    out = []
    for start in ([], [1]):
        name = signed(chain([*start, leaf[0], list(leaf[1:])]))
        out.append(signed(chain([("long", name), a, b, *(("long", signed(chain([*start, list(x)]))) for x in blocks)])))
    return tuple(out)


def brute(rows, least=L.MIN_DOCUMENTS, depth=L.DEPTH, similarity=L.SIMILARITY, reached=None):
    """All templates: a leaf's consensus, then the key held by the most texts, then the line itself."""
    lines = []
    for i, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            t = tokens(line)
            if any(t):
                lines.append((text or "", i, at, (len(t), *t[:depth]), tuple(t)))
    texts_of = defaultdict(set)
    for text, _, _, leaf, _ in lines:
        texts_of[leaf].add(text)
    busy = [x for x in lines if len(texts_of[x[3]]) >= least]
    votes = defaultdict(Counter)
    for _, _, _, leaf, t in busy:
        for p, w in enumerate(t):
            votes[leaf, p][w] += 1
    top = {k: max(c, key=lambda w: (c[w], w.encode())) for k, c in votes.items()}

    def agrees(leaf, t):
        same = sum(top[leaf, p] == t[p] for p in range(depth, len(t)))
        return same >= similarity * max(len(t) - depth, 1)

    holding = defaultdict(set)
    for text, _, _, leaf, t in busy:
        if not agrees(leaf, t):
            for key in line_keys(t, depth, similarity):
                holding[leaf, key].add(text)
    named = []
    for text, i, at, leaf, t in busy:
        own = [(leaf, k) for k in line_keys(t, depth, similarity) if len(holding[leaf, k]) >= least]
        if agrees(leaf, t):
            name, way = leaf, "consensus"
        elif own:  # ties go to the greater digest
            name, way = max(own, key=lambda k: (len(holding[k]), key_digest(*k))), "key"
        else:
            name, way = (leaf, t), "line"
        named.append((text, i, at, name))
        if reached is not None:
            reached[way] += 1
    holders, firsts = defaultdict(set), {}
    for text, i, _, name in named:
        holders[name].add(text)
        key = (i is None, i or 0)
        firsts[name] = min(firsts.get(name, (key, text)), (key, text), key=lambda x: x[0])
    drop = defaultdict(set)
    for text, _, at, name in named:
        if len(holders[name]) >= least and text != firsts[name][1]:
            drop[text].add(at)
    out = []
    for i, text in rows:
        gone = drop.get(text or "", set())
        kept = None if text is None else "\n".join(x for at, x in enumerate(text.split("\n")) if at not in gone)
        out.append((str(i), str(kept)))
    return sorted(out)


def families():
    """A leaf full of prose, with two families of two word fields each among it."""
    lines = [f"see also the {prose(500 + i, 7)}" for i in range(60)]
    names = prose(77, 400).split()
    one = [f"see also the page that {names[i]}x has written on {names[-i - 1]}y" for i in range(6)]
    two = [f"see also the last {names[i]}z of our {names[-i - 1]}w about cats" for i in range(6)]
    texts = [f"{x}\n{prose(2000 + i, 5)}" for i, x in enumerate(lines)]
    texts += [f"{a}\n{b}\n{prose(3000 + i, 5)}" for i, (a, b) in enumerate(zip(one, two))]
    return list(enumerate(texts))


def rows():
    out = odd_rows()
    for i in range(30):
        lines = [prose(900 + i, 12), BOILER[i % 5], prose(700 + i // 2, 9)]
        if i % 4 == 0:
            lines.append("all rights are reserved by the owner of this page")
        out.append((100 + i, "\n".join(lines)))
    out += [(200, out[-1][1]), (201, out[-1][1]), (None, "\n".join(BOILER))]
    return out


def test_decisions_match_a_plain_walk(spark):
    docs = with_extras(spark.createDataFrame(rows(), "doc_id long, text string"))
    cleaned = L.drop_recurring_lines(docs)
    assert cleaned.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in cleaned.collect())
    assert got == brute(rows())


def test_every_kind_of_template_matches_a_plain_walk(spark):
    every = [(1000 + i, t) for i, t in families()] + rows()
    reached = Counter()
    want = brute(every, reached=reached)
    assert all(reached[way] >= 6 for way in ("consensus", "key", "line"))
    docs = spark.createDataFrame(every, "doc_id long, text string")
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in L.drop_recurring_lines(docs).collect()) == want


def test_texts_of_very_many_lines(spark):
    """Time grows with the lines, not with their square: 8 times the lines, far from 64 times the time."""

    def run(n):
        texts = [f"{prose(i, 9)}\n" + "\n".join(f"line of text {x}x{w} here" for x, w in enumerate(prose(9, n).split())) for i in range(4)]
        same = [f"{prose(20 + i, 9)}\n" + "\n".join(["the same line again and again"] * n) for i in range(4)]
        docs = spark.createDataFrame(list(enumerate(texts + same)), "doc_id long, text string")
        begun = time.time()
        got = {r["doc_id"]: r["text"] for r in L.drop_recurring_lines(docs).collect()}
        assert all(got[i] == (texts + same)[i].split("\n")[0] for i in (1, 2, 3, 5, 6, 7)) and got[0] == texts[0]
        return time.time() - begun

    short = run(4_000)
    assert run(32_000) < 20 + 8 * short


def test_boilerplate_goes_but_for_its_first_text(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in L.drop_recurring_lines(docs, column="gone").collect()}
    assert "Posted by" in texts[100] and all("Posted by" not in texts[100 + i] for i in range(1, 29))
    assert "all rights" in texts[100] and "all rights" not in texts[104]
    assert all(prose(900 + i, 12) in texts[100 + i] for i in range(30))


def test_odd_texts_and_empty_table(spark):
    got = {str(r["doc_id"]): r["text"] for r in L.drop_recurring_lines(odd_docs(spark)).collect()}
    assert got["1"] is None and got["2"] == "" and got["3"] == "   \n\t "
    assert L.drop_recurring_lines(empty_docs(spark)).count() == 0


def test_short_lines_recur(spark):
    texts = [f"{prose(40 + i, 9)}\nAll rights reserved.\n\n \t\nHome\nPage {i}" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate([*texts, "Home\nonly here"])), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.drop_recurring_lines(docs).collect()}
    assert got[0] == texts[0] and got[4] == "only here"
    assert all(got[i] == f"{prose(40 + i, 9)}\n\n \t" for i in (1, 2, 3))


def test_second_template_of_a_leaf_is_found(spark):
    texts = [t for _, t in families()]
    assert all(len(line.split()) == 10 for t in texts for line in t.split("\n")[:-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in L.drop_recurring_lines(docs).collect()}
    assert got[60] == texts[60]
    assert all(got[60 + i] == prose(3000 + i, 5) for i in range(1, 6))


def test_a_text_is_digested_once_not_once_a_line(spark):
    """The key of a text is computed below the explode into lines, whose rows then carry no copy of the text."""
    docs = spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")
    plan = L._lines(docs, L.DEPTH)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    generate = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    assert not any("sha2" in line for line in plan[:generate]) and any("sha2" in line for line in plan[generate:])
