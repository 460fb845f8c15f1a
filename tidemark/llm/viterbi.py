"""SentencePiece encoding by Viterbi search with shared prefixes, and decoding.

A text is cut into marked words: a run of spaces with what follows up to the next space, cut again around characters
that no piece contains. No piece reaches over a cut, so the best path of a text is that of its words. The distinct
words of a batch are sorted, which lines them up as a depth-first walk of their trie: the forward scores of a word are
kept as a stack by length, and the next word continues from the prefix that it shares.

The best path has the largest sum of piece scores. Characters without a piece become byte pieces, at a price below that
of any piece. Ids decode to exactly the text that was encoded; null texts are empty and have no ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w
from tidemark.llm.shared import ship

KEPT = 300_000  # words whose ids a Python worker remembers
MARK = "▁"


class Pieces:
    """The pieces of a SentencePiece model with byte fallback, spaces in place of marks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [
            i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.table = {names[i].replace(MARK, " "): (i, model.get_score(i)) for i in plain}
        if any(" " in piece.lstrip(" ") for piece in self.table):
            raise ValueError("a piece reaches over the begin of a word")
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not model.is_byte(i) for i in self.byte_ids):
            raise ValueError("the model has no byte pieces")
        self.byte_score = min(score for _, score in self.table.values()) - 10.0
        # pieces by their characters from the last to the first
        self.backwards: dict = {}
        for piece, entry in self.table.items():
            node = self.backwards
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = entry
        # bytes at which a text is always cut: ASCII controls in no piece
        inside = {ch for piece in self.table for ch in piece}
        self.cut = np.zeros(256, dtype=bool)
        self.cut[[b for b in range(32) if chr(b) not in inside]] = True
        # what each id stands for
        content = [b""] * len(names)
        for piece, (i, _) in self.table.items():
            content[i] = piece.encode()
        for b, i in enumerate(self.byte_ids):
            content[i] = bytes([b])
        self.lengths = np.array([len(c) for c in content], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.known: dict[bytes, bytes] = {}

    def paths(self, sorted_words: list[str]) -> Iterator[list[int]]:
        """The ids of each word; words in order share the scores of their common prefixes."""
        best, back, ids, before = [0.0], [0], [()], ""
        backwards, byte_score, byte_ids = self.backwards, self.byte_score, self.byte_ids
        for word in sorted_words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], ids[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, start, last = None, 0, ()
                node, at = backwards, end
                while at:
                    at -= 1
                    node = node.get(word[at])
                    if node is None:
                        break
                    if "" in node:
                        piece, score = node[""]
                        score += best[at]
                        if top is None or score > top:
                            top, start, last = score, at, (piece,)
                fallback = None
                if top is None or len(last) == 0 or start == end - 1:
                    code = word[end - 1].encode()
                    fallback = best[end - 1] + byte_score * len(code)
                    if top is None or fallback > top:
                        top, start, last = fallback, end - 1, tuple(byte_ids[b] for b in code)
                best.append(top)
                back.append(start)
                ids.append(last)
            before = word
            path, end = [], len(word)
            while end:
                path.append(ids[end])
                end = back[end]
            yield [i for part in reversed(path) for i in part]

    def _distinct(self, words: list[bytes]) -> list[bytes]:
        known = self.known
        new = [x for x in words if x not in known]
        if len(known) + len(new) > KEPT:
            known.clear()
            new = words
        ordered = sorted(x.decode() for x in new)
        for word, path in zip(ordered, self.paths(ordered), strict=True):
            known[word.encode()] = np.array(path, np.uint32).tobytes()
        return [known[x] for x in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        texts = pc.fill_null(texts, "")
        marked = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        data, offsets = w.text_bytes(marked)
        space, cut = data == 32, self.cut[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins |= cut
        begins[1:] |= cut[:-1]
        begins |= w.text_starts(offsets, len(data))
        found, counts = w.pieces(data, offsets, begins, np.ones(len(data), dtype=bool))
        numbers, distinct = w.coded(found)
        ids = self._distinct(distinct.to_pylist())
        lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        flat, starts = np.frombuffer(b"".join(ids), np.uint32), np.concatenate([[0], np.cumsum(lengths)])[: len(ids)]
        each = lengths[numbers] if len(numbers) else np.zeros(0, np.int64)
        ends = np.cumsum(each)
        places = np.repeat(starts[numbers] - (ends - each), each) + np.arange(each.sum()) if len(numbers) else numbers
        total = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return flat[places], np.diff(total)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text."""
        each = self.lengths[ids]
        ends = np.cumsum(each)
        places = np.repeat(self.starts[ids] - (ends - each), each) + np.arange(each.sum())
        data = self.content[places].tobytes()
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b][1:] for a, b in zip(edges[:-1], edges[1:], strict=True)]


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_pieces and ids (little-endian, 4 bytes each) of every row, and the columns to carry along.

    Repeated rows get equal ids each; an empty table gives an empty result.
    """
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for batch in w.slices(batches, "text"):
            ids, counts = table.encode(batch["text"])
            flat, edges = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(counts)]) * 4
            packed = pa.array([flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), packed, *[batch[c] for c in carry]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "ids", *carry])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    carried = "".join(f", {c} {t}" for c, t in docs.select(*carry).dtypes)
    return docs.mapInArrow(rows, f"doc_id long, n_pieces long, ids binary{carried}")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``text``, decoded from ``ids``. Ids that are no UTF-8 together get replacement characters."""
    ship(encoded.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                packed = [x or b"" for x in part["ids"].to_pylist()]
                ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int64)
                texts = table.decode(ids, np.array([len(x) // 4 for x in packed], dtype=np.int64))
                text = pa.array([x.decode(errors="replace") for x in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, "text"])

    return encoded.mapInArrow(rows, f"{', '.join(f'{c} {t}' for c, t in encoded.dtypes)}, text string")
