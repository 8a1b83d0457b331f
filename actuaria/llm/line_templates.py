"""Line deduplication by a log-template tree, in DataFrame functions only.

Every line walks a tree of fixed depth: tokens that hold a digit become a wildcard, the first
level branches on the number of tokens, the next ``DEPTH`` levels on the leading tokens. The
lines that reach one leaf are compared position by position: the most frequent token of each
position is the leaf's *consensus*. A line that agrees with it in at least ``SIMILARITY`` of
the positions after the leading tokens belongs to the leaf's template, whose other positions are variable fields.

A leaf can hold further templates, and where it is full of prose its consensus matches none.
So the other lines are compared on parts of themselves: the positions after the leading tokens
are dealt into ``BLOCKS`` blocks, and the line without any two of them is a *key* if it still has
``SIMILARITY`` of the positions. Keys are counted over all texts; a line joins the template of the key
held by the most texts, ``min_documents`` at least. Any two variable fields lie in two blocks, so
they never part the lines of a template. A line without such a key is a template of its own
masked tokens.

A template is *recurring* when it occurs in at least ``min_documents`` documents of different
text (copies of one text are one document here: whole-document copies are another
operator's work). Recurring lines are dropped, except in the first text that
holds the template, so that no content vanishes from the corpus; the first text is that of
the smallest doc_id.

Lines are counted by 128-bit digests, combined before the shuffle, so a line that stands in a third of
all documents costs one row a task. Only leaves met in enough texts are compared token by
token. Decisions depend on the text alone and go back to the documents by content key. The work on a
text grows with its length, however many lines it has: a text is split once, never once a line.

A line of at most ``DEPTH`` tokens walks as many levels as it has tokens: it is matched exactly
on its masked tokens.

Defined results: null text has no lines and stays null; blank lines are always kept; repeated lines of one text are one
occurrence, and are kept or dropped together; ties between tokens go to the smaller token;
rows without doc_id come last in the order of texts, ties there to the smaller content key; an
empty table gives an empty result; extra columns pass through untouched.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, fresh_name, stored, whole_text

DEPTH = 3  # leading tokens that choose the branch
SIMILARITY = 0.5
BLOCKS = 6
MIN_TOKENS = 1  # every line that is not blank
MIN_DOCUMENTS = 3
MASK = "<*>"
# a token with a digit; possessive, so that one pass over a long token is enough
DIGIT_TOKEN = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"


def _digest(*values: Column) -> Column:
    """128 bits that stand for the values: two hashes of different seeds."""
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b"))


def line_tokens(line: Column) -> Column:
    """Tokens of a line with those that hold a digit masked."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, DIGIT_TOKEN, MASK)).otherwise(line)
    return F.split(F.trim(masked), r"\s+")


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """The lines of every row by their position: digests of the leaf and of the masked tokens.

    Nested transforms and the explode above them compute a line's tokens once; a filter or
    projection over exploded lines would compute them again for each use.
    """
    described = F.transform(
        F.transform(F.split(whole_text(), "\n", -1), line_tokens),
        lambda t: F.struct(
            # white space can only leave the first and the last token empty
            F.when((F.size(t) > 2) | (F.get(t, F.lit(0)) != "") | (F.element_at(t, -1) != ""), F.size(t)).otherwise(0).alias("size"),
            _digest(F.size(t), F.slice(t, 1, depth)).alias("leaf"),
            _digest(t).alias("exact"),
        ),
    )
    # the key stands below the explode: beside it, it would be digested again for each line, from a copy of the text
    texts = docs.select(content_key(whole_text()).alias("k"), "doc_id", described.alias("described"))
    rows = texts.select("k", "doc_id", F.posexplode("described").alias("at", "line"))
    return rows.where(F.col("line.size") >= MIN_TOKENS).select("k", "doc_id", "at", "line.leaf", "line.exact")


def _keys(depth: int, similarity: float) -> Column:
    """Digests of a line's tokens without any two blocks; those left with too few positions are out."""
    rest = F.size("tokens") - depth

    def block(b: int) -> Column:
        return F.filter("tokens", lambda t, i: (i >= depth) & ((i - depth) % BLOCKS == b))

    blocks = [block(b) for b in range(BLOCKS)]
    line = F.struct(
        F.array(*(F.size(b) for b in blocks)).alias("sizes"), F.array(*(_digest(b) for b in blocks)).alias("digests"),
        F.col("leaf").alias("leaf"),
    )

    def keys_of(x: Column) -> Column:
        out = []
        for a, b in combinations(range(BLOCKS), 2):
            left = rest - F.get(x["sizes"], F.lit(a)) - F.get(x["sizes"], F.lit(b))
            kept = [F.get(x["digests"], F.lit(i)) for i in range(BLOCKS) if i not in (a, b)]
            enough = (left > 0) & (left >= similarity * rest)
            half = {h: F.xxhash64(x["leaf"][h], F.lit(a), F.lit(b), *(d[h] for d in kept)) for h in ("a", "b")}
            out.append(F.when(enough, F.struct(*(v.alias(h) for h, v in half.items()))))
        return F.array_compact(F.array(*out))

    # one transform, so that the blocks are digested once
    return F.get(F.transform(F.array(line), keys_of), F.lit(0))


def recurring_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, depth: int = DEPTH, similarity: float = SIMILARITY
) -> DataFrame:
    """Positions to drop, per text: k (content key) and drop (array of line numbers)."""
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k")
    thin = stored(_lines(docs, depth), "lines")
    # leaves met in enough texts: distinct texts are counted from rows combined beforehand
    busy = (
        thin.select("leaf", "k").distinct().groupBy("leaf").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents).select("leaf")
    )
    # stored before the join: right above its aggregate it would share that aggregate's
    # shuffle, and a leaf with very many lines could not be split
    busy = stored(busy, "leaves")
    lines = stored(thin.join(busy, "leaf").select("k", "doc_id", "at", "leaf", "exact"), "busy")

    # the tokens of one occurrence of each different masked line of those leaves
    wanted = (
        lines.groupBy("leaf", "exact").agg(F.min(F.struct("k", "at")).alias("w"), F.count("*").alias("n"))
        .groupBy(F.col("w.k").alias("k")).agg(F.collect_list(F.struct("leaf", "exact", "n", "w.at")).alias("w"))
    )
    texts = docs.select(content_key(whole_text()).alias("k"), whole_text().alias("text"))
    # A one-element explode splits a text once and keeps the lines a column of their own, where the
    # transform below would split anew for each line; exploding lines beside it would copy it for each.
    opened = texts.join(wanted, "k").select("w", F.explode(F.array(F.split("text", "\n", -1))).alias("all"))
    chosen = F.transform(
        "w", lambda x: F.struct(x["leaf"].alias("leaf"), x["exact"].alias("exact"), x["n"].alias("n"), F.get("all", x["at"]).alias("line"))
    )
    picked = opened.select(F.explode(chosen).alias("w"))
    tokens = stored(
        picked.select("w.leaf", "w.exact", "w.n", line_tokens(F.col("w.line")).alias("tokens"))
        .dropDuplicates(["leaf", "exact"]),
        "tokens",
    )

    # consensus of each leaf: the most frequent token of each position
    positions = tokens.select("leaf", "n", F.posexplode("tokens").alias("p", "token"))
    votes = positions.groupBy("leaf", "p", "token").agg(F.sum("n").alias("n"))
    top = votes.groupBy("leaf", "p").agg(F.max_by("token", F.struct("n", "token")).alias("token"))
    consensus = top.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("p", "token"))).alias("c"))
    # the leading tokens agree already: the rest must do so by itself
    same = F.slice(F.zip_with("tokens", F.col("c.token"), lambda a, b: (a == b).cast("int")), depth + 1, 1 << 30)
    agreed = F.aggregate(same, F.lit(0), lambda s, x: s + x)
    agrees = agreed >= similarity * F.greatest(F.size("tokens") - depth, F.lit(1))
    judged = stored(
        tokens.join(consensus, "leaf").select("leaf", "exact", agrees.alias("agrees"), F.when(~agrees, _keys(depth, similarity)).alias("keys")),
        "judged",
    )

    # the other lines: the key that most texts hold; counted from distinct pairs of key and text
    apart = judged.where(F.size("keys") > 0).select("leaf", "exact", "keys")
    holds = lines.select("leaf", "exact", "k").distinct().join(apart, ["leaf", "exact"])
    often = stored(
        holds.select("k", F.explode("keys").alias("key")).distinct().groupBy("key").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents),
        "keys",
    )
    chosen = (
        apart.select("leaf", "exact", F.explode("keys").alias("key")).join(often, "key")
        .groupBy("leaf", "exact").agg(F.max_by("key", F.struct("n", "key")).alias("key"))
    )
    template = F.when(F.col("agrees"), F.col("leaf")).otherwise(F.coalesce("key", "exact"))
    templates = judged.join(chosen, ["leaf", "exact"], "left").select("leaf", "exact", template.alias("template"))
    # stored before the join, like the leaves: a line met very often can then be split
    templates = stored(templates, "templates")

    named = stored(lines.join(templates, ["leaf", "exact"]).select("k", "doc_id", "at", "template"), "named")
    holders = named.groupBy("template", "k").agg(F.min(order).alias("o"))
    counted = (
        holders.groupBy("template").agg(F.count("*").alias("n"), F.min("o").alias("first"))
        .where(F.col("n") >= min_documents).select("template", F.col("first.k").alias("first"))
    )
    counted = stored(counted, "recurring")
    dropped = named.join(counted, "template").where(F.col("k") != F.col("first"))
    return dropped.groupBy("k").agg(F.array_sort(F.collect_set("at")).alias("drop"))


def drop_recurring_lines(docs: DataFrame, column: str | None = None, **options) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``; all columns and rows kept.

    ``column`` names an extra output column with the number of dropped lines.
    """
    key, drop, count = fresh_name(docs, "_text_key"), fresh_name(docs, "_drop"), column or fresh_name(docs, "_dropped")
    found = recurring_lines(docs.select("doc_id", "text"), **options)
    found = found.select(F.col("k").alias(key), F.col("drop").alias(drop))
    joined = docs.withColumn(key, content_key(whole_text())).join(found, key, "left")
    lines = fresh_name(joined, "_lines")
    # split once, as above, and only where lines go; positions are taken out as sets
    split = F.when(F.col(drop).isNotNull(), F.split("text", "\n", -1))
    opened = joined.withColumn(lines, F.explode(F.array(split)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop))
    text = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    out = opened.withColumn(
        "text", F.when(F.col(drop).isNull(), F.col("text")).otherwise(text)
    ).withColumn(count, F.coalesce(F.size(drop), F.lit(0)).cast("long"))
    return out.select(*docs.columns, *([column] if column else []))
