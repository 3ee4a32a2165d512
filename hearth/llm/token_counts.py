"""Token counts by a compiled finite-state tokenizer.

A byte-pair vocabulary with ranked pieces is run as a deterministic transducer
over characters. After any prefix of a text there is one last token, namely the
piece that ends there and stands next to the token before it exactly as the two
would be tokenized on their own; so a state needs only the open text (the longest
suffix that begins some piece), the last tokens at its places, and the counts
relative to now. Every transition is annotated with the tokens it adds (fewer
tokens, where pieces melt together, is a negative number). States are compiled
when first met.

Where no piece contains a pair of neighbouring characters, the transducer is back
in its start state whatever came before. A chunk of text is therefore a state
map: its head, up to the first such place, still depends on the state at entry;
the rest is a fixed count and an open tail. State maps compose associatively, and
the chunks of a text are folded in a balanced scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.llm.common import Shipped, append_columns

BLANK = "▁"            # how the vocabulary writes a space
CHUNK_CHARS = 1 << 16
MEMO = 200_000              # chunk counts and states a task keeps
CUT = re.compile(f"{BLANK}+[^{BLANK}\n]*|\n|[^{BLANK}\n]+")


class Vocabulary:
    """Pieces that merges may form, with their ranks (low first); characters
    outside are written as their UTF-8 bytes."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.begins = {p[:i] for p in ranks for i in range(1, len(p))}
        self.pairs = {p[i:i + 2] for p in ranks for i in range(len(p) - 1)}
        self.blank_cuts = all(p.lstrip(BLANK).find(BLANK) < 0 and "\n" not in p for p in ranks)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size())
                  if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
        normal.sort(key=lambda i: (-model.get_score(i), i))
        return cls({model.id_to_piece(i): r for r, i in enumerate(normal)})

    def weight(self, token: str) -> int:
        return 1 if token in self.ranks else len(token.encode("utf-8", "surrogatepass"))

    def merged(self, text: str) -> list[str]:
        """Plain pair merging: the best-ranked pair first, of equals the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts


class Transducer:
    """States: (open text, last token per place, relative count per place)."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._reset()

    def _reset(self) -> None:
        self.states = [("", (None,), (0,))]
        self.number = {self.states[0]: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]
        self.fits: dict[tuple[str, str], bool] = {}

    def _side_by_side(self, left: str | None, right: str) -> bool:
        if left is None or left[-1] + right[0] not in self.v.pairs:
            return True
        key = (left, right)
        if key not in self.fits:
            self.fits[key] = self.v.merged(left + right) == [left, right]
        return self.fits[key]

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        text, last, count = self.states[state]
        if text and text[-1] + char not in self.v.pairs:
            text, last, count = "", (None,), (0,)
        text += char
        for size in range(len(text), 0, -1):
            token = text[-size:]
            at = len(text) - size
            if (size == 1 or token in self.v.ranks) and self._side_by_side(last[at], token):
                break
        added = count[at] + self.v.weight(token)
        keep = next((k for k in range(len(text), 0, -1) if text[-k:] in self.v.begins), 0)
        text, last, count = text[len(text) - keep:], (*last, token)[-keep - 1:], (*count, added)[-keep - 1:]
        # places where no piece can begin that is still open do not tell states apart
        live = [i == keep or text[i:] in self.v.begins for i in range(keep + 1)]
        new = (text, tuple(t if x else "" for t, x in zip(last, live)),
               tuple(c - added if x else 0 for c, x in zip(count, live)))
        if new not in self.number:
            self.number[new] = len(self.states)
            self.states.append(new)
            self.next.append({})
        self.next[state][char] = step = (self.number[new], added)
        return step

    def run(self, text: str) -> int:
        """Tokens of a text read from the start state."""
        if len(self.states) > MEMO or len(self.fits) > 4 * MEMO:
            self._reset()
        state, total = 0, 0
        for char in text:
            step = self.next[state].get(char)
            if step is None:
                step = self._compile(state, char)
            state, added = step
            total += added
        return total


class Counts(dict):
    """Chunk between two cuts -> its tokens; forgets everything when full."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, chunk: str) -> int:
        n = self.transducer.run(chunk)
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = n
        return n


@dataclass
class StateMap:
    """What a stretch of text does to any entry state. ``tail`` None: it has no
    place of reset, so all of it is ``head``."""

    head: str
    count: int = 0
    tail: str | None = None


class Tokenizer:
    """Counts of normalised texts (spaces already written as ``BLANK``)."""

    def __init__(self, vocabulary: Vocabulary):
        self.cuts = vocabulary.blank_cuts
        self.counts = Counts(Transducer(vocabulary))

    def map_of(self, text: str) -> StateMap:
        """State map of a chunk. Resets are sought before blanks and around line
        ends, where this vocabulary has them; else the chunk stays open."""
        if not self.cuts:
            return StateMap(text)
        if BLANK + BLANK not in text and "\0" not in text:
            parts = text.replace(BLANK, "\0" + BLANK).replace("\n", "\0\n\0").split("\0")
        else:
            parts = CUT.findall(text)
            if text[:1] in (BLANK, "\n"):
                parts.insert(0, "")
        if text[:1] == BLANK:       # may continue blanks before the chunk
            del parts[0]
        if len(parts) < 2:
            return StateMap(text)
        return StateMap(parts[0], sum(map(self.counts.__getitem__, parts[1:-1])), parts[-1])

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None and b.tail is None:
            return self.map_of(a.head + b.head) if self.cuts else StateMap(a.head + b.head)
        if a.tail is None:
            joined = self.map_of(a.head + b.head)
            if joined.tail is None:
                return StateMap(joined.head, b.count, b.tail)
            return StateMap(joined.head, joined.count + self.counts[joined.tail] + b.count, b.tail)
        middle = self.map_of(a.tail + b.head)
        if b.tail is None:
            if middle.tail is None:
                return StateMap(a.head, a.count, middle.head)
            return StateMap(a.head, a.count + self.counts[middle.head] + middle.count, middle.tail)
        inner = self.counts[middle.head]
        if middle.tail is not None:
            inner += middle.count + self.counts[middle.tail]
        return StateMap(a.head, a.count + inner + b.count, b.tail)

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        maps = [self.map_of(text[i:i + CHUNK_CHARS]) for i in range(0, len(text), CHUNK_CHARS)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        m = maps[0]
        return self.counts[m.head] + m.count + (self.counts[m.tail] if m.tail is not None else 0)


def normalised(text: str) -> str:
    """As the model does it: one blank in front, spaces as blanks; empty stays empty."""
    return BLANK + text.replace(" ", BLANK) if text else ""


def counts_of(texts: Iterable[str | None], tokenizer: Tokenizer) -> list[int]:
    return [tokenizer.count(normalised(t)) if t else 0 for t in texts]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` plus ``n_tokens`` of the whole ``text`` (null and empty: 0)."""
    column = docs.columns.index("text")
    shipped = Shipped(docs.sparkSession, vocabulary)

    def run(batches):
        tokenizer = Tokenizer(shipped.get())
        for batch in batches:
            yield batch, [pa.array(counts_of(batch.column(column).to_pylist(), tokenizer), pa.int64())]

    return append_columns(docs, [T.StructField("n_tokens", T.LongType())], run)
