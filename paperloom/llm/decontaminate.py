"""Finding benchmark items in documents by exact pieces and bit-parallel edit distance.

An item with an error budget of ``e`` edits is split into ``e + 1`` pieces: whatever the
edits, one piece stays whole. An automaton finds all pieces in one pass over each text,
and around each hit Myers' bit-parallel algorithm computes the least edit distance
between the item and any part of the text. Items so short that their budget is no edit at
all would be met by chance inside words; they match between word boundaries. Items go to
the tasks in blocks of bounded size; a larger benchmark means more blocks, each a pass
over all documents whose result is written before the next block is read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paperloom.llm.exact_dedup import names_every_row, numbered_rows
from paperloom.session import cut_lineage

#: Edits allowed per character of an item.
ERROR_RATE = 0.08
#: Characters of items in one block: what is sent to the tasks at once.
BLOCK_CHARS = 4_000_000
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def normalised(text: str | None) -> str:
    """Lower case, white space runs as one space, trimmed; null as empty."""
    return _SPACE.sub(" ", text or "").strip(" ").lower()


# Scripts written without spaces (Thai to Myanmar, Khmer, kana and Han).
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def _joined(left: str, right: str) -> bool:
    """Whether two neighbouring characters are inside one word; scripts without spaces have no such words."""
    return all((c.isalnum() or c == "_" or unicodedata.combining(c)) and not _UNSPACED.match(c) for c in (left, right))


def stands_alone(text: str, begin: int, end: int) -> bool:
    """Whether ``text[begin:end]`` begins and ends at word boundaries."""
    return not (begin > 0 and _joined(text[begin - 1], text[begin])) and not (end < len(text) and _joined(text[end - 1], text[end]))


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` parts of nearly equal length, each with its place in the item."""
    n, k = len(item), errors + 1
    cuts = [n * j // k for j in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def best_distance(masks: dict[str, int], size: int, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of a pattern to any part of ``text``, and where that part ends (first if tied).

    ``masks`` has for each character of the pattern the bits of its places.
    """
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, distance, best = full, 0, size, (most + 1, -1)
    for at, letter in enumerate(text):
        eq = masks.get(letter, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (~(xh | plus) & full), plus & xh
        distance += 1 if ph & top else -1 if mh & top else 0
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus, minus = mh | (~(xv | ph) & full), ph & xv
        if distance < best[0]:
            best = (distance, at + 1)
    return best


class Matcher:
    """A block of items, ready to be searched in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, places = [], {}
        for item_id, text in items:
            errors = int(len(text) * rate)
            if not errors:
                places.setdefault(text, []).append((len(self.items), 0))
                self.items.append((item_id, text, 0, None))
                continue
            masks: dict[str, int] = {}
            for k, letter in enumerate(text):
                masks[letter] = masks.get(letter, 0) | (1 << k)
            for at, piece in pieces(text, errors):
                places.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, text, errors, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int]]:
        """``(item_id, distance)`` of every item within its budget somewhere in ``text``."""
        if not self.items or not text:
            return
        windows: dict[int, list[tuple[int, int]]] = {}
        alone: set[int] = set()
        for end, (size, where) in self.automaton.iter(text):
            for number, at in where:
                item = self.items[number]
                begin = end + 1 - size - at
                if item[3] is None:
                    if number not in alone and stands_alone(text, begin, end + 1):
                        alone.add(number)
                        yield item[0], 0
                    continue
                found = windows.setdefault(number, [])
                span = (max(0, begin - item[2]), begin + len(item[1]) + item[2])
                if found and span[0] <= found[-1][1]:
                    found[-1] = (min(found[-1][0], span[0]), max(found[-1][1], span[1]))
                else:
                    found.append(span)
        for number, spans in windows.items():
            item_id, item, errors, masks = self.items[number]
            best = errors + 1
            for a, b in spans:
                if best:
                    best = 0 if item in text[a:b] else min(best, best_distance(masks, len(item), text[a:b], errors)[0])
            if best <= errors:
                yield item_id, best


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    items = benchmark.select("item_id", "text").filter("text is not null").distinct().orderBy("item_id", "text")
    for row in items.toLocalIterator():
        text = normalised(row["text"])
        if not text:
            continue
        block.append((row["item_id"], text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance`` for each document that holds an item with at most ``rate`` edits a character.

    Both sides are compared in lower case with single spaces. ``distance`` is the least
    over the whole text. Items whose budget is no edit match as whole words. Null or empty
    texts and items match nothing, items without id match under a null id. Repeated rows
    repeat in the result; equal items under different ids each match. Without documents or
    items there are no rows. Other columns are ignored, and ids may have any simple type.
    """
    source = docs.select("doc_id", "text").filter("text is not null")
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds['doc_id']}, item_id {item_kind}, distance int"
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def search(block):
        def searched(batches, block=block):
            matcher = Matcher(block, rate)
            for batch in batches:
                ids, items, distances = [], [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    for item_id, distance in matcher.search(normalised(text.as_py())):
                        ids.append(doc_id)
                        items.append(item_id)
                        distances.append(distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("doc_id").type), pa.array(items, item_type), pa.array(distances, pa.int32())],
                    ["doc_id", "item_id", "distance"],
                )

        return source.mapInArrow(searched, schema)

    result = last = None
    for block in _blocks(benchmark, block_chars):
        if last is not None:  # a block before the last: its result is written, so that no plan holds two blocks
            part = cut_lineage(search(last), "leaks")
            result = part if result is None else result.unionByName(part)
        last = block
    if last is None:
        return docs.sparkSession.createDataFrame([], schema)
    return search(last) if result is None else result.unionByName(search(last))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, each judged by its own text."""
    if names_every_row(docs):
        leaks = find_leaks(docs, benchmark).select("doc_id").distinct()
        return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)
    rows = numbered_rows(docs)
    leaks = find_leaks(rows.select(F.col("__paperloom_row").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__paperloom_row")).distinct()
    return rows.join(leaks, "__paperloom_row", "left_anti").select(docs.columns)
