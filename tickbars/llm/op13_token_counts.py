"""Token counts by a compiled finite-state tokenizer.

A tokenizer of byte pairs with word ends is compiled into two deterministic transducers. The splitter reads classes of
characters (letter, number, white space, other) and marks where words begin; a number is a word of its own, and an
apostrophe that stands alone takes the letters of a contraction. The counter reads a word's bytes, the last as a symbol of its
own, and emits with each the change of the number of tokens of what it has read, so the sum over a text is its count.

The counter rests on a fact of merge lists whose merges come after those of their parts: tokens are the tokenizer's result if and only if each
two neighbours are, and the last token of each beginning is one and only one. A state holds, for each rest of what was read that
begins some token, the trie's node of that rest, the last token before it and how many tokens fewer end there. A symbol then
moves all of them, and the one whose node is a token that its last token admits is the new last token. Rests that no
admitted token continues are left out, so words with the same outlook share a state. States and transitions are made when first
needed and kept, `STATES` at most between segments.

Symbols are cut into chunks of `CHUNK` and all chunks run side by side. A chunk in which a word begins maps every
state to one, that of its tail; an exclusive scan (the last such chunk) gives the others their entry, and heads are then run from it,
in as many rounds as a word has chunks. Counts are added up by prefix sums.

Normalisation is the library's. Where it is no more than lower case (composed text without a capital sigma or unassigned characters), Python's is
used, which is the same; classes of characters are asked of the library once each.

Edge cases: null and empty text have no tokens; special strings in a text are one token each, as the library takes them; repeated rows are counted
each; a long text is read in parts cut at white space, about 100 bytes of memory for each character of a part; an empty table gives no rows;
further columns are left out.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 64
#: Symbols that are run at once, and states that are kept between such segments.
SEGMENT = 1 << 18
STATES = 1 << 18
BATCH_CHARS = 1 << 18
LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)
#: What an apostrophe takes to itself.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Rests that more tokens begin with are kept without asking whether the last token admits one.
LOOK = 4

_CUT = re.compile("[ \n]")

#: (trie node, last token, tokens fewer) of each rest
State = tuple[tuple[int, int, int], ...]
NOTHING = -1


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves, the rest counted from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Tokens as sequences of symbols: a byte, or 256 more at the end of a word."""

    def __init__(self, model: dict):
        if model.get("end_of_word_suffix") != "</w>" or any(model.get(k) for k in ("continuing_subword_prefix", "byte_fallback", "ignore_merges", "dropout")):
            raise ValueError("a merge list with word ends and nothing else is compiled")
        letters = byte_letters()

        def symbols(token: str) -> tuple[int, ...]:
            ended = token.endswith("</w>") and token != "</w>"
            found = [letters[c] for c in (token[:-4] if ended else token)]
            return (*found[:-1], found[-1] + 256 * ended)

        numbers = {}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.symbols: list[tuple[int, ...]] = []
        for s in range(512):
            self.symbols.append((s,))
        self.parts: list[tuple[int, int] | None] = [None] * 512
        self.rank: dict[tuple[int, int], int] = {}
        made = {(s,): s for s in range(512)}
        for i, (left, right) in enumerate(pairs):
            for name in (left, right):
                if name not in numbers:
                    numbers[name] = made[symbols(name)]
            pair = numbers[left], numbers[right]
            whole = self.symbols[pair[0]] + self.symbols[pair[1]]
            if whole not in made:
                made[whole] = len(self.symbols)
                self.symbols.append(whole)
                self.parts.append(pair)
                self.rank[pair] = i
        if max(map(len, self.symbols)) > 120:
            raise ValueError("a token is too long for the counter's table")
        # The trie: children of node and symbol, and the token that ends in a node.
        self.child: dict[tuple[int, int], int] = {}
        self.below: list[list[int]] = [[]]
        self.token: list[int] = [NOTHING]
        for number, sequence in enumerate(self.symbols):
            node = 0
            for s in sequence:
                after = self.child.get((node, s))
                if after is None:
                    after = self.child[node, s] = len(self.token)
                    self.below.append([])
                    self.token.append(NOTHING)
                    self.below[node].append(after)
                node = after
            self.token[node] = number
        # Nodes are numbered after those above them.
        self.longer = [0] * len(self.token)
        for node in range(len(self.token) - 1, -1, -1):
            self.longer[node] = sum(self.longer[a] + (self.token[a] != NOTHING) for a in self.below[node])
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._admitted: dict[tuple[int, int], bool] = {}
        self._outlook: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, int]]:
        """The pieces at a token's edge, each with the rank of the merge that takes it."""
        found = known.get(token)
        if found is None:
            found, taken, piece = [], 1 << 40, token
            while True:
                found.append((piece, taken))
                pair = self.parts[piece]
                if pair is None:
                    break
                taken, piece = self.rank[pair], pair[side]
            known[token] = found
        return found

    def admits(self, last: int, token: int) -> bool:
        """Whether the two stand side by side: no piece at the one's end merges with one at the other's beginning first.

        Of two merges of one rank the left one comes first.
        """
        if last == NOTHING:
            return True
        answer = self._admitted.get((last, token))
        if answer is None:
            answer = True
            for a, a_taken in self._edge(last, 1, self._right):
                for b, b_taken in self._edge(token, 0, self._left):
                    rank = self.rank.get((a, b))
                    if rank is not None and rank < a_taken and rank <= b_taken:
                        answer = False
            self._admitted[last, token] = answer
        return answer

    def goes_on(self, node: int, last: int) -> bool:
        """Whether `last` admits a token that is longer than the node; yes without a look if many are."""
        if self.longer[node] == 0 or last == NOTHING:
            return self.longer[node] > 0
        if self.longer[node] > LOOK:
            return True
        answer = self._outlook.get((node, last))
        if answer is None:
            answer, ways = False, list(self.below[node])
            while ways and not answer:
                at = ways.pop()
                answer = self.token[at] != NOTHING and self.admits(last, self.token[at])
                ways += self.below[at]
            self._outlook[node, last] = answer
        return answer

    def move(self, state: State, symbol: int) -> tuple[State, int]:
        """The state after a symbol, and how many tokens more there are."""
        moved, found = [], []
        for node, last, fewer in state:
            after = self.child.get((node, symbol))
            if after is not None:
                moved.append((after, last, fewer))
                if self.token[after] != NOTHING and self.admits(last, self.token[after]):
                    found.append((self.token[after], fewer))
        if len(found) != 1:
            raise ValueError("the merge list has merges before those of their parts")
        token, fewer = found[0]
        more = 1 - fewer
        rests = [(after, last, fewer + more) for after, last, fewer in moved if self.goes_on(after, last)]
        return (*rests, (0, token, 0)), more

    def forget(self) -> None:
        self._admitted.clear()
        self._outlook.clear()


START: State = ((0, NOTHING, 0),)


def packed(state: int, more: int) -> int:
    """A cell of the counter's table: the next state above 8 bits for the change, which no token is long enough to fill."""
    return state << 8 | more + 128


class Counter:
    """The counting transducer as tables that grow; columns are the symbols met so far, column 0 leaves a state as it is."""

    def __init__(self, merges: Merges, chunk: int = CHUNK, segment: int = SEGMENT, most: int = STATES):
        self.merges, self.chunk, self.segment, self.most = merges, chunk, segment, most
        self.column = np.zeros(512, np.int64)
        self.symbol = [NOTHING]
        self._clear()

    def _clear(self) -> None:
        self.states: list[State] = []
        self.number: dict[State, int] = {}
        columns = max(64, 1 << (len(self.symbol) - 1).bit_length())
        self.table = np.full((1 << 10, columns), NOTHING, np.int32)
        self.merges.forget()
        self._intern(START)

    def _intern(self, state: State) -> int:
        at = self.number.get(state)
        if at is None:
            at = self.number[state] = len(self.states)
            self.states.append(state)
            if at == len(self.table):
                self._grow(2 * at, self.table.shape[1])
            self.table[at, 0] = packed(at, 0)
        return at

    def _grow(self, rows: int, columns: int) -> None:
        old = self.table
        self.table = np.full((rows, columns), NOTHING, np.int32)
        self.table[: old.shape[0], : old.shape[1]] = old

    def _columns(self, symbols: np.ndarray) -> np.ndarray:
        for s in np.flatnonzero(np.bincount(symbols, minlength=512)):
            if not self.column[s]:
                self.column[s] = len(self.symbol)
                self.symbol.append(int(s))
                if len(self.symbol) > self.table.shape[1]:
                    self._grow(self.table.shape[0], 2 * self.table.shape[1])
        return self.column[symbols]

    def _compile(self, states: np.ndarray, columns: np.ndarray) -> None:
        for at, column in {*zip(states.tolist(), columns.tolist())}:
            symbol = self.symbol[column]
            after, more = self.merges.move(self.states[at], symbol)
            # A word's end leads back to the start.
            number = 0 if symbol >= 256 else self._intern(after)
            self.table[at, column] = packed(number, more)

    def _run(self, lanes: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lanes of columns side by side, each from its state -> the states after them, and what each symbol emits."""
        emitted = np.empty(lanes.shape[::-1], np.int32)
        for i, columns in enumerate(np.ascontiguousarray(lanes.T)):
            found = self.table.ravel().take(states * self.table.shape[1] + columns)
            if found.min(initial=0) < 0:
                new = found < 0
                self._compile(states[new], columns[new])
                found = self.table.ravel().take(states * self.table.shape[1] + columns)
            emitted[i] = found
            states = found >> 8
        return states.astype(np.int64), ((emitted & 255) - 128).astype(np.int8).T

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """The change of the number of tokens at each symbol; words follow each other, each ended by a symbol of 256 or more."""
        out = np.zeros(len(symbols), np.int8)
        entry = 0
        for begin in range(0, len(symbols), self.segment):
            if len(self.states) > self.most:
                held = self.states[entry]
                self._clear()
                entry = self._intern(held)
            entry = self._segment(symbols[begin : begin + self.segment], entry, out[begin : begin + self.segment])
        return out

    def _segment(self, symbols: np.ndarray, entry: int, out: np.ndarray) -> int:
        size = self.chunk
        n = -(-len(symbols) // size)
        lanes = np.zeros(n * size, np.int64)
        lanes[: len(symbols)] = self._columns(symbols)
        lanes = lanes.reshape(n, size)
        # A chunk's tail begins where its first word does; before that it is the head.
        ends = np.zeros(n * size, bool)
        ends[1 : len(symbols)] = symbols[:-1] >= 256
        ends = ends.reshape(n, size)
        resets = ends.any(1)
        first = np.where(resets, ends.argmax(1), size)
        tail = np.arange(size) >= first[:, None]
        exits, emitted = self._run(np.where(tail, lanes, 0), np.zeros(n, np.int64))
        # The first chunk is entered from outside, each other from the exit of the one before it.
        done = resets.copy()
        waiting = np.arange(n)
        entries = np.full(n, NOTHING, np.int64)
        entries[0] = entry
        entries[1:][done[:-1]] = exits[:-1][done[:-1]]
        while len(waiting):
            ready = waiting[entries[waiting] >= 0]
            after, heads = self._run(np.where(tail[ready], 0, lanes[ready]), entries[ready])
            emitted[ready] += heads
            waiting = waiting[entries[waiting] < 0]
            through = ready[~resets[ready]]
            exits[through] = after[~resets[ready]]
            onward = through[through + 1 < n] + 1
            entries[onward] = exits[onward - 1]
        out[:] = emitted.reshape(-1)[: len(symbols)]
        # The state after the last symbol, also where that ended a word or the last chunk isn't full.
        return int(exits[-1])


class Compiled:
    """A tokenizer file as splitter and counter."""

    def __init__(self, path: str, chunk: int = CHUNK, segment: int = SEGMENT, most: int = STATES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.counter = Counter(Merges(parsed["model"]), chunk, segment, most)
        added = parsed["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special strings are plain text that is looked for before normalisation")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.plain: dict[str, bool] = {}

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        for c in {*text} - self.plain.keys():
            self.plain[c] = c != "Σ" and unicodedata.category(c) != "Cn"
        if all(map(self.plain.__getitem__, {*text})) and unicodedata.is_normalized("NFC", text):
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def _classes(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (found == UNKNOWN).any():
            for point in np.unique(points[found == UNKNOWN]).tolist():
                pieces = len(self.library.pre_tokenizer.pre_tokenize_str(f"a{chr(point) * 2}a"))
                self.classes[point] = {1: LETTER, 2: SPACE, 3: OTHER, 4: NUMBER}[pieces]
            found = self.classes[points]
        return found

    def begins(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The splitter: which characters are in words, and which begin one."""
        kind = self._classes(points)
        n = len(points)
        begins = np.ones(n, bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        # An apostrophe alone among others, before a letter.
        marks = np.flatnonzero((points[:-1] == 0x27) & begins[:-1] & (kind[1:] == LETTER))
        following = [points[np.minimum(marks + k, n - 1)] for k in (1, 2)]
        for taken in CONTRACTIONS:
            fits = marks
            if len(marks):
                ok = following[0] == ord(taken[0])
                if len(taken) == 2:
                    ok &= (following[1] == ord(taken[1])) & (marks + 2 < n)
                fits = marks[ok]
            begins[fits + 1] = False
            rest = fits + 1 + len(taken)
            rest = rest[rest < n]
            begins[rest[kind[rest] == LETTER]] = True
        return kind != SPACE, begins

    def counts(self, texts: list[str]) -> np.ndarray:
        """Numbers of tokens."""
        special = np.zeros(len(texts), np.int64)
        parts = []
        for i, text in enumerate(texts):
            if self.special is not None and "<" in text:
                text, special[i] = self.special.subn(" ", text)
            parts.append(self.normal(text))
        lengths = np.array([len(p) + 1 for p in parts], np.int64)
        # White space after each text, so words end with it.
        joined = " ".join([*parts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        inside, begins = self.begins(points)
        widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        data = np.frombuffer(joined.encode(), np.uint8)
        # A character ends a word if the next one begins one or is outside.
        ends = inside.copy()
        ends[:-1] &= begins[1:] | ~inside[1:]
        last_byte = np.cumsum(widths) - 1
        symbols = data.astype(np.int64)
        symbols[last_byte[ends]] += 256
        kept = np.repeat(inside, widths)
        emitted = self.counter.emissions(symbols[kept])
        total = np.concatenate(([0], np.cumsum(emitted, dtype=np.int64)))
        bounds = np.concatenate(([0], np.cumsum(kept)[last_byte[np.cumsum(lengths) - 1]])) if len(texts) else np.zeros(1, np.int64)
        return np.diff(total[bounds]) + special


def pieces(text: str, size: int = BATCH_CHARS) -> Iterator[str]:
    """The text in parts of about `size`, each but the first beginning with white space, which no token and no composed letter spans."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def counted(compiled: Compiled, texts: Iterable[str | None], rows: int) -> np.ndarray:
    """Numbers of tokens of `rows` texts, some at a time."""
    out = np.zeros(rows, np.int64)
    held: list[str] = []
    owners: list[int] = []
    size = 0

    def add() -> None:
        nonlocal size
        np.add.at(out, owners, compiled.counts(held))
        held.clear()
        owners.clear()
        size = 0

    for row, text in enumerate(texts):
        for piece in pieces(text or ""):
            held.append(piece)
            owners.append(row)
            size += len(piece)
            if size >= BATCH_CHARS:
                add()
    if held:
        add()
    return out


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, text -> doc_id, n_bytes, n_tokens, over_limit; `path` must be readable on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = None
        for batch in batches:
            compiled = compiled or Compiled(path)
            n = counted(compiled, (t.as_py() for t in batch.column(1)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "text", size.alias("n_bytes"))
    return sized.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(TOKENIZER))
