"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

One pass over a text finds, at each position, all pieces that end there (the automaton's
output links) and relaxes each of them against the best encoding of the text before the
piece. For a model of byte-pair merges an encoding's score is that of its merges, so a piece
relaxes a position only if merging leaves it and its left neighbour apart; for a unigram
model the scores are added. Characters outside the vocabulary become byte pieces.

No piece goes on after white space or crosses a character that is in no piece, so a text is
encoded in runs that end there, and runs are cached per worker with a bounded number of
entries. Ids are those of the model's library, without begin and end tokens.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import cache

import ahocorasick
import numpy as np
import sentencepiece
from pyspark.sql import DataFrame

from crisis_posts.llm.shared import Memo, bpe_merge, map_rows

_SPACE = "▁"
_NO = float("-inf")
_PAIR = 1 << 24
_UNIGRAM = 1


class Pieces:
    def __init__(self, path: str, cache_entries: int = 300_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.special = {i for i in range(size) if special[i]}
        self.numeral = [str(i) for i in range(size)]
        self.is_byte = np.array([i in self.byte_of for i in range(size)])
        self.unknown = model.unk_id()
        self.ids = {
            p: i for i, p in enumerate(self.pieces)
            if not special[i] and i not in self.byte_of
        }
        self.score = [model.get_score(i) for i in range(size)]
        self.merges = sentencepiece_kind(path) != _UNIGRAM
        self.spelled = [
            bytes([self.byte_of[i]]) if i in self.byte_of
            else b"" if i in self.special
            else piece.replace(_SPACE, " ").encode()
            for i, piece in enumerate(self.pieces)
        ]
        self.automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            self.automaton.add_word(piece, (len(piece), number))
        self.automaton.make_automaton()
        self.single = {piece for piece in self.ids if len(piece) == 1}
        self.longest = max(map(len, self.ids))
        self.sizes = [len(piece) for piece in self.pieces]
        self.runs = re.compile(self._run_pattern())
        self.apart = Memo(self._stay_apart, 2 * cache_entries)
        self.run_ids = Memo(self._encode_run, cache_entries)

    def _run_pattern(self) -> str:
        """Cuts a text where no piece holds the characters on both sides of the cut."""
        if any(_SPACE in piece.lstrip(_SPACE) for piece in self.ids):
            return "(?s:.+)"
        inner = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        before = {mark: {a for a, b in inner if b == mark} for mark in "\t\n\r.,"}
        within = {c for pair in inner for c in pair}
        lone = "".join(c for c in "\t\n\r" if c not in within)
        run = f"{_SPACE}*[^{_SPACE}{lone}]+"
        if marks := "".join(c for c in ".," if not any(map(str.isalpha, before[c]))):
            # A word, where no piece goes on from its letters into the mark.
            other = "".join(re.escape(a) for a in sorted(set().union(*(before[c] for c in marks))))
            run = f"{_SPACE}*[^\\W\\d_{other}]+(?=[{marks}])|{run}"
        return f"{run}|{_SPACE}+" + (f"|[{lone}]" if lone else "")

    def _stay_apart(self, pair: int) -> bool:
        """Whether merging leaves two pieces, numbered from 1; a left one of 0 is the start."""
        left, right = divmod(pair, _PAIR)
        texts = [self.pieces[i - 1] for i in (left, right) if i]
        if len(texts) == 2 and not self._may_cross(*texts):
            return self.apart[left] and self.apart[right]

        def rank(a: str, b: str) -> float | None:
            found = self.ids.get(a + b)
            return None if found is None else -self.score[found]

        return bpe_merge(list("".join(texts)), rank) == texts

    def _merged(self, run: str) -> list[int]:
        """The last piece of each prefix, where all characters are pieces: one relaxes, not more."""
        last = [-1] + [-2] * len(run)
        apart = self.apart
        for end, (size, number) in self.automaton.iter(run):
            if last[end + 1] == -2:
                left = last[end + 1 - size]
                if left != -2 and apart[(left + 1) * _PAIR + number + 1]:
                    last[end + 1] = number
        out, at, sizes = [], len(run), self.sizes
        while at:
            out.append(last[at])
            at -= sizes[last[at]]
        return out[::-1]

    def _may_cross(self, left: str, right: str) -> bool:
        """Whether any piece could hold the end of one and the beginning of the other."""
        ids = self.ids
        ends = [left[-i:] for i in range(1, min(len(left), self.longest - 1) + 1)]
        return any(end + right[:j] in ids for end in ends for j in range(1, len(right) + 1))

    def _viterbi(self, run: str) -> list[int]:
        """Best score, last piece and its start for each prefix of a run; then the way back."""
        if self.merges and self.single.issuperset(run):
            return self._merged(run)
        n = len(run)
        best, last, start = [_NO] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        ends = self.automaton.iter(run)
        found = next(ends, None)
        for at in range(1, n + 1):
            while found is not None and found[0] == at - 1:
                size, number = found[1]
                before = at - size
                score = best[before] + self.score[number]
                if score > best[at] and (not self.merges or self.apart[(last[before] + 1) * _PAIR + number + 1]):
                    best[at], last[at], start[at] = score, number, before
                found = next(ends, None)
            if best[at] == _NO and run[at - 1] not in self.single:
                best[at], start[at] = best[at - 1], at - 1  # a character without a piece
        out, at = [], n
        while at:
            if last[at] >= 0:
                out.append(last[at])
            elif self.bytes:
                out += [self.bytes[b] for b in reversed(run[start[at] : at].encode())]
            else:
                out.append(self.unknown)
            at = start[at]
        return out[::-1]

    def _encode_run(self, run: str) -> bytes:
        return array("i", self._viterbi(run)).tobytes()

    def encode(self, text: str) -> array:
        """The ids of a text."""
        out = array("i")
        if text:
            spaced = _SPACE + text.replace(" ", _SPACE)
            cached, plain = self.run_ids, self._encode_run
            runs = self.runs.findall(spaced)
            out.frombytes(b"".join([cached[r] if len(r) <= 64 else plain(r) for r in runs]))
        return out

    def decode(self, ids) -> str:
        """The text of ids: the leading space that encoding adds is taken away again."""
        spelled = self.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ")


def sentencepiece_kind(path: str) -> int:
    """The model type in a model file (1: unigram, 2: byte-pair merges)."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    return proto.trainer_spec.model_type


@cache
def encoder(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of each whole text; a null or empty text has no ids.

    Columns besides doc_id and text are not looked at; rows with equal doc_id keep their number.
    """

    def encode(rows):
        pieces = encoder(path)
        for doc, text in rows:
            yield doc, np.frombuffer(pieces.encode((text or b"").decode()), np.int32)

    return map_rows(documents.select("doc_id", "text"), "doc_id long, ids array<int>", encode)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from doc_id and ids; null ids give null."""

    def decode(rows):
        pieces = encoder(path)
        for doc, ids in rows:
            yield doc, None if ids is None else pieces.decode(ids)

    return map_rows(encoded.select("doc_id", "ids"), "doc_id long, text string", decode)


def encoding_digests(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_chars, n_pieces, n_byte_pieces, ids_sha256, round_trip) in one pass.

    ids_sha256 is over the ids, comma-joined; n_byte_pieces counts pieces that stand for one
    byte; round_trip says whether decoding gives the text back. It does but for texts that
    hold U+2581, which the model's alphabet uses for a space, and ids stay those of the library.
    """

    def digest(rows):
        pieces = encoder(path)
        for doc, text in rows:
            decoded = (text or b"").decode()
            ids = pieces.encode(decoded)
            joined = ",".join(map(pieces.numeral.__getitem__, ids)).encode()
            n_bytes = int(np.count_nonzero(pieces.is_byte[np.frombuffer(ids, np.int32)])) if ids else 0
            yield (
                doc, len(decoded), len(ids), n_bytes,
                hashlib.sha256(joined).hexdigest(), pieces.decode(ids) == decoded,
            )

    schema = (
        "doc_id long, n_chars long, n_pieces long, n_byte_pieces long, ids_sha256 string, "
        "round_trip boolean"
    )
    return map_rows(documents.select("doc_id", "text"), schema, digest)
