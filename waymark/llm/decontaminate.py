"""Operator 9, benchmark decontamination with one Aho-Corasick automaton over word sequences.

Benchmark texts are normalised (ASCII lower case, words of digits, ASCII letters and other scripts); every run of `window`
consecutive words of an item is a pattern, and a shorter item is one pattern as a whole. The words of the patterns are
numbered, and the automaton is built over the sequences of numbers; a document, turned into numbers once (0 for a word
that no item has), is scanned once, whatever the number of items. A hit is a word inside an occurrence; hits are mapped
back to code points of the original text.

The benchmark is the only thing that goes to the driver and to each executor, at most `block_words` words of it at a time: that
bounds the broadcast and the automaton, which takes about 1 kB a word (13 nodes), 250 MB at the default. A worker builds it once and keeps
it for the tasks that follow. A benchmark beyond the bound is fetched block by block; the document rows are scanned for
one block after another and written between, each scan adding its hits to the row, so nothing is shuffled at any size.

Cases: null and empty texts have no words and are clean; texts of any length are scanned whole; rows that repeat are scanned each; a
hit in several blocks or of several items counts once; items without words match nothing; a missing item_id counts as
the id ''; rows of equal item_id are one item; equal documents are scanned each; an empty benchmark leaves all clean; other
columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.llm.common import slices, stored, texts

#: Words in the original text: the normalised words' characters before lower-casing.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


class Automaton:
    """Patterns of a block of items [(item id, text)]."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        import ahocorasick

        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in normal_words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners[tuple(ids[i : i + window])].add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, found in owners.items():
            self.automaton.add_word(key, (len(key), tuple(found)))
        self.empty = not owners
        if not self.empty:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words [first, last) in order, and the items found."""
        if self.empty or not words:
            return [], set()
        get, runs, items = self.number.get, [], set()
        for end, (k, found) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            items.update(found)
            runs.append((end - k + 1, end + 1))
        return merged(runs), items


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list[tuple[str, str]], window: int) -> Automaton:
    """A block's automaton; a worker keeps the last one."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most block_words words, fetched one partition at a time. A larger item is cut into pieces that overlap by a window less a word, so that every window lies in one of them."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text_col}`").cast("string").alias("t")).where("t is not null")
    for item, text in rows.toLocalIterator():
        words = normal_words(text)
        step = max(1, block_words - window + 1)
        pieces = [text] if len(words) <= max(window, block_words) else [b" ".join(words[i : i + step + window - 1]).decode() for i in range(0, len(words) - window + 1, step)]
        for piece in pieces:
            n = min(len(words), max(window, block_words))
            if block and size + n > block_words:
                yield block
                block, size = [], 0
            block.append((item, piece))
            size += n
    yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = 250_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, n_words, n_hit (words inside an occurrence), items (ids found, sorted as strings), spans (code points of the hit words' runs in the original)."""
    rows = texts(docs, id_col, text_col).select("doc_id", "text", F.lit(None).cast("array<struct<a:int,b:int>>").alias("runs"), F.lit(None).cast("array<string>").alias("items"))
    found = StructType.fromDDL("n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>")
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_words)
    block = next(blocks)
    for following in blocks:  # rows are written between blocks, so that one block and one automaton are held at a time
        rows = stored(rows.mapInArrow(_scanner(context.broadcast(block), window, False), rows.schema), "decontaminate")
        block = following
    return rows.mapInArrow(_scanner(context.broadcast(block), window, True), StructType([rows.schema["doc_id"], *found.fields]))


_RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _scanner(shared, window: int, last: bool):
    """Adds what a block finds to runs and items of each row; the last block's makes the result of them."""
    key = uuid.uuid4().hex

    def run(batches):
        automaton = None
        for batch in batches:
            automaton = automaton or _automaton(key, shared.value, window)
            for lo, n in slices(batch.column(1)):
                part = batch.slice(lo, n)
                all_runs, items, n_words, n_hit, spans = [], [], [], [], []
                for text, before, found in zip(*[part.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                    words = normal_words(text)
                    runs, own = automaton.scan(words)
                    if before:
                        runs = merged(runs + [(x["a"], x["b"]) for x in before])
                    items.append(sorted(own.union(found or ())))
                    if last:
                        n_words.append(len(words))
                        n_hit.append(sum(b - a for a, b in runs))
                        at = [m.span() for m in _WORD.finditer(text)] if runs else []
                        spans.append([{"start": at[a][0], "stop": at[b - 1][1]} for a, b in runs])
                    else:
                        all_runs.append([{"a": a, "b": b} for a, b in runs])
                items = pa.array(items, pa.list_(pa.string()))
                if last:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), items, pa.array(spans, _SPANS)], names=["doc_id", "n_words", "n_hit", "items", "spans"])
                else:
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(all_runs, _RUNS), items], names=["doc_id", "text", "runs", "items"])

    return run


def contaminated(n_hit, n_words, one_in: int = 20):
    """The contract's rule: hit words make at least one in `one_in`."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns: a row rides along as the id, so nothing is joined."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = find_contamination(rows, benchmark, window, id_col="row")
    return found.where(~contaminated(F.col("n_hit"), F.col("n_words"), one_in)).select("doc_id.*")
