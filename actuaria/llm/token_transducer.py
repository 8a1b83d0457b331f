"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

*Why a transducer.* A sequence of pieces is the encoding of its text if, and only if, each
two neighbours are the encoding of theirs: a merge over a border of two neighbours would happen
in the two by themselves just the same. So the last piece of every prefix of a text is found from
left to right: of the pieces that end here, it is the only one that agrees with the last piece of
the prefix before it. What decides about the future is finite, and is the *state*: the longest end
of the text that a piece could still continue, and for each place inside it, that a piece could begin at,
the last piece up to there and its token count relative to now. Where no piece holds the two
characters around a place, every two pieces agree there, and the last piece is left out of the
state: after a space that follows a word the state is the same whatever stood before.

*Compilation.* A transition (state, character) -> state is annotated with the tokens that it
emits: the count of the new prefix less that of the old one (it may be negative). States
reached by no text need no table, so transitions are compiled when first met and kept for all later texts
of a worker; beyond ``MAX_STATES`` the table starts again, which costs time only. Where no piece holds a
space after another character, a word leads from the state before it back to that state: words met
before are transitions of their own, over all their characters at once.

*Chunks.* Texts over ``CHUNK`` characters are cut into chunks that are counted by different
tasks. The map of a chunk gives, per state at its entry, the state at its exit and the tokens emitted between. The
entry state is taken from the ``LOOK`` characters before it; where the exit of the chunk before
is another state, the map gets that entry too (followed through the next chunks at once), until
every exit is an entry of the next map.
Maps compose associatively, ``RADIX`` neighbours at a time in parallel, up to one map a text.

Defined results: null is the empty text, of 0 tokens and bytes; equal texts give equal rows, each
counted; texts of any length and without any space are whole; strings of special tokens are plain
text, as in the library; characters unknown to the vocabulary count a token for each
UTF-8 byte; an empty table gives an empty result; null doc_id is kept; other columns are not read.
"""

from __future__ import annotations

import gc
import json
import re
import sys
from collections.abc import Iterator
from types import ModuleType

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import content_key, stored, whole_text

CHUNK = 1 << 16  # characters
LOOK = 256
RADIX = 64
MAX_STATES = 250_000  # some 300 MB
MAX_WORDS, WORD_LENGTH = 200_000, 24
WORD = re.compile("▁+[^▁]*|[^▁]+")
START = ("", ((0, "", 0),))


class Transducer:
    """Counts the tokens of normalised text; ``states`` maps a state's key to its transitions."""

    def __init__(self, model: bytes, max_states: int = MAX_STATES):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(self.library.vocab_size())
        if not any(map(self.library.is_byte, ids)) or any(map(self.library.is_unused, ids)):
            raise ValueError("a vocabulary with byte pieces and without unused ones is needed")
        self.score = {
            self.library.id_to_piece(i): self.library.get_score(i)
            for i in ids
            if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i))
        }
        self.open = {p[:i] for p in self.score for i in range(1, len(p))}  # what a piece can continue
        self.pairs = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.agreed: dict[tuple[str, str], bool] = {}
        self.max_states = max_states
        self.states: dict[tuple, dict] = {}
        self.by_word = not any(b == "▁" != a for a, b in self.pairs)
        self.words: dict[str, int] = {}  # met lately
        self.earlier: dict[str, int] = {}  # met before those

    def normal(self, text: str) -> str:
        return self.library.normalize(text)

    def state(self, key: tuple) -> dict:
        """The transitions of a state: character -> (transitions of the next, emitted); None -> its key."""
        return self.states.setdefault(key, {None: key})

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by definition: the best pair first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(self.score.get(a + b), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = max((p for p in pairs if p[0] is not None), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def agree(self, before: str, piece: str) -> bool:
        """Whether the two are the encoding of their concatenation (``before`` empty: a free border)."""
        known = self.agreed.get((before, piece))
        if known is None:
            known = self.merged(before + piece) == ([before, piece] if before else [piece])
            self.agreed[before, piece] = known
        return known

    def compile(self, state: dict, char: str) -> tuple[dict, int]:
        """The transition of ``state`` on ``char``."""
        end, places = state[None]
        for back, before, relative in reversed(places):  # the longest piece first; only one agrees
            piece = end[len(end) - back :] + char
            if back and piece not in self.score:
                continue
            if before and before[-1] + piece[0] not in self.pairs:
                before = ""
            if self.agree(before, piece):
                emitted = relative + (1 if piece in self.score else len(piece.encode("utf-8")))
                break
        else:
            raise AssertionError(f"no piece ends at {char!r}")
        longer = end + char
        while longer and longer not in self.open:
            longer = longer[1:]
        known = {back: (before, relative) for back, before, relative in places}
        after = [(0, piece, 0)]
        for back in range(1, len(longer) + 1):
            if longer[-back:] in self.open:
                before, relative = known[back - 1]
                if before and before[-1] + longer[-back] not in self.pairs:
                    before = ""
                after.append((back, before, relative - emitted))
        if len(self.states) >= self.max_states:
            self.states.clear()
            self.agreed.clear()
            gc.collect()
        step = self.state((longer, tuple(after))), emitted
        state[char] = step
        return step

    def run(self, key: tuple, text: str) -> tuple[tuple, int]:
        """Exit state and tokens emitted over a text, from the state ``key``."""
        state, count = self.state(key), 0
        for char in text:
            step = state.get(char) or self.compile(state, char)
            state = step[0]
            count += step[1]
        return state[None], count

    def count(self, text: str) -> int:
        text = self.normal(text)
        if not self.by_word:
            return self.run(START, text)[1]
        total = 0
        for word in WORD.findall(text):
            n = self.words.get(word)
            total += self.word(word) if n is None else n
        return total

    def word(self, word: str) -> int:
        """Tokens of a word with the spaces before it; kept unless it is long."""
        n = self.earlier.get(word)
        if n is None:
            n = self.run(START, word)[1]
        if len(word) <= WORD_LENGTH:
            if len(self.words) >= MAX_WORDS:
                self.earlier, self.words = self.words, {}
            self.words[word] = n
        return n


def _name(key: tuple) -> str:
    return json.dumps(key, ensure_ascii=False)


def _key(name: str) -> tuple:
    end, places = json.loads(name)
    return end, tuple(map(tuple, places))


def worker_transducer(model: bytes) -> Transducer:
    """The transducer of this worker process: what one task has compiled serves the next."""
    kept = sys.modules.setdefault("actuaria_worker_tables", ModuleType("actuaria_worker_tables")).__dict__
    if kept.get("model") != model:
        kept.update(model=model, transducer=Transducer(model))
    return kept["transducer"]


def load_model(path: str) -> bytes:
    """The vocabulary file, read on the driver, checked to be of the kind that is compiled here."""
    with open(path, "rb") as file:
        model = file.read()
    probe = Transducer(model)
    pieces = sorted(probe.score)
    sample = "".join(pieces[:: max(1, len(pieces) // 2000)]).replace("▁", " ")
    if probe.count(sample) != len(probe.library.encode(sample)):
        raise ValueError(f"{path} is not a BPE vocabulary with merges by score")
    return model


MAP = "k binary, no long, entry string, exit string, n long"


def chunk_maps(chunks: DataFrame, model: bytes) -> DataFrame:
    """(k, no, entry, exit, n) of chunks (k, no, look, body), entered from their ``look``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = worker_transducer(model)
        for batch in batches:
            rows = []
            for k, no, look, body in zip(*(batch[c] for c in ("k", "no", "look", "body"))):
                begin = machine.run(START, look)[0]
                end, n = machine.run(begin, body)
                rows.append((k, no, _name(begin), _name(end), n))
            yield pd.DataFrame(rows, columns=["k", "no", "entry", "exit", "n"])

    return chunks.select("k", "no", "look", "body").mapInPandas(run, MAP)


def missing_maps(chunks: DataFrame, maps: DataFrame, wanted: DataFrame, model: bytes) -> DataFrame:
    """The maps' further rows for the ``wanted`` entries (k, no, entry), followed through up to ``RADIX`` chunks."""
    block = F.expr(f"no div {RADIX}").alias("block")
    places = wanted.select("k", block).distinct()
    bodies = chunks.select("k", block, "no", "body").join(places, ["k", "block"])
    known = maps.select("k", block, "no", "entry", F.lit(True).alias("done"))
    known = known.unionByName(wanted.select("k", block, "no", "entry", F.lit(False).alias("done")))
    known = known.join(places, ["k", "block"], "left_semi")

    def follow(bodies: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        machine, rows, open_ = worker_transducer(model), [], {}
        done = {(no, entry) for no, entry, d in zip(known["no"], known["entry"], known["done"]) if d}
        for no, entry, d in zip(known["no"], known["entry"], known["done"]):
            if not d:
                open_.setdefault(no, set()).add(entry)
        for no, body, k in sorted(zip(bodies["no"], bodies["body"], bodies["k"])):
            for entry in sorted(open_.get(no, ())):
                if (no, entry) not in done:
                    end, n = machine.run(_key(entry), body)
                    rows.append((k, no, entry, _name(end), n))
                    open_.setdefault(no + 1, set()).add(_name(end))
        return pd.DataFrame(rows, columns=["k", "no", "entry", "exit", "n"])

    return bodies.groupBy("k", "block").cogroup(known.groupBy("k", "block")).applyInPandas(follow, MAP)


def composed(maps: DataFrame) -> DataFrame:
    """(k, n): tokens of each text from the closed maps of its chunks."""
    each = F.map_from_entries(F.collect_list(F.struct("entry", F.struct("exit", "n").alias("to")))).alias("m")
    level = maps.groupBy("k", "no").agg(each)
    last = maps.agg(F.max("no")).first()[0] or 0
    while last:
        parts = level.groupBy("k", F.expr(f"no div {RADIX}").alias("no")).agg(
            F.min("no").alias("first"), F.max("no").alias("last"),
            F.map_from_entries(F.collect_list(F.struct("no", "m"))).alias("parts"),
        )
        rest = F.slice(F.sequence("first", "last"), 2, RADIX)

        def through(entry, to):
            def next_part(done, no):
                found = F.element_at(F.element_at("parts", no), done["exit"])
                return F.struct(found["exit"].alias("exit"), (done["n"] + found["n"]).alias("n"))

            return F.aggregate(rest, to, next_part)

        whole = F.transform_values(F.element_at("parts", F.col("first")), through)
        level = parts.select("k", "no", whole.alias("m"))
        last //= RADIX
    return level.select("k", F.get(F.map_values("m"), F.lit(0))["n"].alias("n_tokens"))  # one entry: the start


def long_counts(texts: DataFrame, model: bytes, chunk: int = CHUNK, look: int = LOOK) -> DataFrame:
    """(k, n_tokens) of each different text, by chunks spread over the tasks."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = worker_transducer(model)
        for batch in batches:
            for k, text in zip(batch["k"], batch["text"]):
                text, rows = machine.normal(text), []
                for no, at in enumerate(range(0, len(text), chunk)):
                    rows.append((k, no, text[max(0, at - look) : at], text[at : at + chunk]))
                    if len(rows) == 64 or at + chunk >= len(text):  # bounded output frames
                        yield pd.DataFrame(rows, columns=["k", "no", "look", "body"])
                        rows = []

    cuts = texts.mapInPandas(cut, "k binary, no long, look string, body string")
    chunks = stored(cuts.dropDuplicates(["k", "no"]), "chunks")  # copies of a text are combined before the shuffle
    maps = stored(chunk_maps(chunks, model), "maps")
    while True:
        exits = maps.select("k", (F.col("no") + 1).alias("no"), F.col("exit").alias("entry")).distinct()
        wanted = exits.join(maps, ["k", "no", "entry"], "left_anti").join(chunks, ["k", "no"], "left_semi")
        wanted = stored(wanted, "wanted")
        if wanted.isEmpty():
            return composed(maps)
        maps = stored(maps.unionByName(missing_maps(chunks, maps, wanted, model)), "maps")


def count_tokens(docs: DataFrame, model_path: str, chunk: int = CHUNK, look: int = LOOK) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs``."""
    model = load_model(model_path)  # some hundred kB
    texts = docs.select("doc_id", whole_text().alias("text"))
    is_long = F.length("text") > chunk
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = worker_transducer(model)
        for batch in batches:
            counts = [machine.count(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": counts})

    # doc_id crosses to Python as text: pandas would turn integers beside nulls into floats
    kind = docs.schema["doc_id"].dataType
    short = (
        texts.where(~is_long).select(F.col("doc_id").cast("string"), n_bytes, "text")
        .mapInPandas(count, "doc_id string, n_bytes long, n_tokens long")
        .select(F.col("doc_id").cast(kind).alias("doc_id"), "n_bytes", "n_tokens")
    )
    keyed = texts.where(is_long).select("doc_id", n_bytes, "text", content_key(F.col("text")).alias("k"))
    totals = stored(long_counts(keyed.select("k", "text"), model, chunk, look), "totals")
    return short.unionByName(keyed.select("doc_id", n_bytes.alias("n_bytes"), "k").join(totals, "k").drop("k"))
