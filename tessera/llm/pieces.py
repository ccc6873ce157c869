"""SentencePiece encoding and decoding by a streaming Viterbi search."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .spans import SpanStore
from .tables import table
from .words import list_column, slices, span_hashes, text_buffers

SPACE = "▁"

_models: dict[str, "Pieces"] = {}


class Pieces:
    """A SentencePiece model: its pieces and scores, and the search for the segmentation of a text.

    Unigram models: the segmentation with the largest sum of scores; of equals the one whose last piece
    is longer. BPE models: the one that merging by score gives; as a prefix of a text has only one last piece
    that agrees with the one before it (the two merge to just them), the same search finds it.
    Only the identity normaliser is supported, with or without a space put before a text.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        proto = ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models that do not normalise are supported")
        processor = SentencePieceProcessor(model_file=path)
        self.bpe, self.prefix, self.unknown = proto.trainer_spec.model_type == 2, norm.add_dummy_prefix, processor.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [-1] * 256
        self.bytes: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type in (1, 4):  # normal, user-defined
                self.ids[p.piece], self.scores[p.piece] = i, p.score
            if p.type == 6:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                self.bytes.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                self.bytes.append(b" \xe2\x81\x87 " if p.type == 2 else b"" if p.type == 3 else p.piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.ids))
        self.commits = 0  # how often a part of a window has become final
        self.starts = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        # no piece has a space after anything else, so a text may be cut before any space that follows another sign
        # (without bytes for them, runs of unknown signs must not be cut).
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.ids) and (self.byte_ids[0] >= 0 or SPACE in self.ids)
        # line ends and tabs stand alone if no piece has them.
        self.alone = [c for c in "\t\n\r" if not any(c in p for p in self.ids)] if self.byte_ids[0] >= 0 else []
        self.worst = min(self.scores.values()) - 10
        self._split: dict[str, tuple[str, str] | None] = {}
        self._agree: dict[tuple[str, str], bool] = {}
        self.store = SpanStore(lambda texts: [self.encode(t) for t in texts])

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that merging joins last to make this one; none for a single sign."""
        if piece not in self._split:
            parts = list(piece)
            while len(parts) > 2:
                best = max(((self.scores.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1)))
                i = -best[1]
                if best[0] == -np.inf:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._split[piece] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._split[piece]

    def agree(self, left: str, right: str) -> bool:
        """Whether merging left + right gives these two pieces.

        It doesn't if a merge across their border comes before the merges that make them up. From the
        last merge of either backwards, the pieces at the border are compared at each point in time.
        """
        if (left, right) in self._agree:
            return self._agree[left, right]
        a, b, score, found = left, right, self.scores, True
        limit, after_left = -np.inf, False  # merges with a larger score, or an equal one further left, come before
        while True:
            across = score.get(a + b)
            if across is not None and (across > limit or (across == limit and not after_left)):
                found = False
                break
            sa, sb = self.split(a), self.split(b)
            if not sa and not sb:
                break
            # the later of the two last merges is undone: the smaller score, and of equals the right one
            if sa and (not sb or score[a] < score[b]):
                limit, after_left, a = score[a], True, sa[1]
            else:
                limit, after_left, b = score[b], False, sb[0]
        if len(self._agree) > 2_000_000:
            self._agree.clear()
        self._agree[left, right] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text, in which a space stands for itself and no space is put before it.

        The search keeps the last piece of the best segmentation of each prefix. Only the last `longest`
        prefixes can be extended; where the ways back from all of them pass one border, the pieces up to it are
        final: their ids are handed on and their part of the window is dropped. This is tried every `longest` signs.
        """
        text = text.replace(" ", SPACE)
        out: list[int] = []
        base, back, best = 0, [""], [0.0]  # all is final up to base; back[i]: last piece of the prefix of length base + i
        ids, starts, scores, known, agree, bpe = self.ids, self.starts, self.scores, self._agree, self.agree, self.bpe
        ring = self.longest + 1
        ending: list[list[str]] = [[] for _ in range(ring)]  # pieces by the place where they end, the longest first
        n = len(text)
        for i in range(n):
            stop = i + 1
            while stop <= n and (piece := text[i:stop]) in starts:
                if piece in ids:
                    ending[stop % ring].append(piece)
                stop += 1
            here = ending[(i + 1) % ring]
            chosen, value = None, -np.inf
            if bpe:
                for piece in here:
                    last = back[i + 1 - len(piece) - base]
                    if last not in ids or (known[last, piece] if (last, piece) in known else agree(last, piece)):
                        chosen = piece
                        break
            else:
                for piece in here:
                    if (total := best[i + 1 - len(piece) - base] + scores[piece]) > value:
                        chosen, value = piece, total
                # a sign that is no piece may stand alone, too, whatever longer pieces end there
                if text[i] not in ids and (total := best[-1] + self.worst) > value:
                    chosen, value = None, total
                best.append(value)
            here.clear()
            back.append(text[i] if chosen is None else chosen)  # a sign that no piece has stands alone
            if (i + 1) % self.longest == 0 and len(back) > self.longest and (border := self._border(back)):
                self.commits += 1
                out += self._ids(back, border)
                base += border
                back = back[border:]
                best = [x - best[border] for x in best[border:]] if not bpe else best
        out += self._ids(back, len(back) - 1)
        if self.byte_ids[0] < 0:  # a run of signs that no piece has is one unknown
            out = [x for k, x in enumerate(out) if x != self.unknown or k == 0 or out[k - 1] != x]
        return out

    def _border(self, back: list[str]) -> int:
        """The last border that the ways back from all prefixes that can still be extended pass."""
        ends = set(range(len(back) - self.longest, len(back)))
        while len(ends) > 1:
            at = max(ends)
            ends.remove(at)
            ends.add(at - len(back[at]))
        return max(ends.pop(), 0)

    def _ids(self, back: list[str], end: int) -> list[int]:
        pieces = []
        while end > 0:
            pieces.append(back[end])
            end -= len(back[end])
        out: list[int] = []
        for piece in reversed(pieces):
            if (i := self.ids.get(piece)) is not None:
                out.append(i)
            elif self.byte_ids[0] >= 0:
                out += [self.byte_ids[x] for x in piece.encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin. Distinct parts between cuts are searched once."""
        data, at = text_buffers(column)
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        if self.cuts and len(data):
            space = data == 32
            cut[1:-1] |= space[1:] & ~space[:-1]
        for c in self.alone:
            hit = np.flatnonzero(data == ord(c))
            cut[hit] = cut[hit + 1] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        first = np.isin(starts, at[:-1][np.diff(at) > 0]) if self.prefix else np.zeros(len(starts), bool)
        hashes = span_hashes(data, starts, ends) ^ (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ids, begin = self.store.values(self.store.codes(hashes, data, starts, ends, first))
        return ids, begin[np.searchsorted(starts, at)]

    def decode_column(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        sizes = np.array([len(b) for b in self.bytes], np.int64)
        offsets, flat = np.append(0, np.cumsum(sizes)), np.frombuffer(b"".join(self.bytes), np.uint8)
        n = sizes[ids]
        ends = np.cumsum(n)
        raw = flat[np.repeat(offsets[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        spots = np.append(0, ends)[at].tolist()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(spots, spots[1:])]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _rest(df: DataFrame, drop: str, more: list[T.StructField]) -> tuple[T.StructType, pa.Schema]:
    schema = T.StructType([f for f in df.schema.fields if f.name != drop] + more)
    if len({f.name for f in schema.fields}) < len(schema.fields):
        raise ValueError(f"the table already has one of the columns {[f.name for f in more]}")
    return schema, to_arrow_schema(schema)


def encode(df: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """df without the text, with ids (array<int>) and ids_crc32 (of little-endian 32-bit ids); no shuffle.

    Null and empty texts have no ids. The ids equal those of the SentencePiece library. Texts longer than
    a chunk are searched in parts that no piece crosses. Every row is encoded on its own, so rows may repeat; an
    empty table gives an empty one. Other columns stay; one that is already called ids or ids_crc32 is an error.
    """
    schema, arrow = _rest(df, text_col, [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for part in slices(batch, text_col):
                ids, at = model.encode_column(part.column(text_col))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), at[1:].tolist())]
                columns = [part.column(c) for c in part.schema.names if c != text_col]
                yield pa.RecordBatch.from_arrays([*columns, list_column(ids.astype(np.int32), np.diff(at), pa.int32()), pa.array(crc, pa.int64())], schema=arrow)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """df without the ids, with their text in `decoded`; null ids give null, unknown ids the library's sign for them.

    No ids give an empty text. Rows may repeat; an empty table gives an empty one. Other columns stay; one that is already called
    decoded is an error.
    """
    schema, arrow = _rest(df, ids_col, [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                lists = part.column(ids_col)
                sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                texts = model.decode_column(np.asarray(lists.flatten(), np.int64), np.append(0, np.cumsum(sizes)))
                columns = [part.column(c) for c in part.schema.names if c != ids_col]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string(), mask=np.array(lists.is_null()))], schema=arrow)

    return df.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"))
    encoded = encode(docs, default_model()).withColumn("n_ids", F.size("ids"))
    done = decode(encoded, default_model()).withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256))
    return done.select("doc_id", "n_ids", "ids_crc32", "decoded_sha256", (F.col("decoded_sha256") == F.col("sha256")).alias("round_trip"))
