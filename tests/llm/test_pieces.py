"""SentencePiece encoding against the library, and spans against the source."""

from __future__ import annotations

import hashlib
import struct
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalake.llm import pieces
from stratalake.llm.queries import QUERIES

from .conftest import ODD_TEXTS, SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def check_spans(text, ids, begins, ends):
    """Spans follow each other over the whole text, and hold the text of their pieces."""
    raw = text.encode()
    assert list(begins) == [0, *list(ends)[:-1]][: len(ids)] and (not ids or ends[-1] == len(raw))
    for i, b, e in zip(ids, begins, ends, strict=True):
        piece = LIBRARY.id_to_piece(i)
        if LIBRARY.is_byte(i):
            # the first byte of an unknown character carries its whole span
            assert e - b in (0, 1, 2, 3, 4)
        elif "▁" not in text:
            shown = raw[b:e].decode()
            assert shown == piece.replace("▁", " ") or b == 0 and " " + shown == piece.replace("▁", " ")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab,'s \n\t\ré 　×-1<s>▁\u0085日😀", max_size=40), max_size=5))
def test_ids_are_the_librarys(texts):
    model = pieces.Model.at(PATH)
    assert model.chunks is not None
    column = pa.array(texts, pa.string())
    ids, counts = model.encode(column)
    split = [x.tolist() for x in np.split(ids, np.cumsum(counts))[:-1]]
    assert split == [LIBRARY.encode(t) for t in texts]
    begins, ends = model.spans(column, ids, counts)
    cuts = np.cumsum(counts)
    for t, i, b, e in zip(texts, split, np.split(begins, cuts)[:-1], np.split(ends, cuts)[:-1], strict=True):
        check_spans(t, i, b.tolist(), e.tolist())


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab ,é日▁", max_size=20))
def test_vectorised_spans_equal_the_general_ones(text):
    model = pieces.Model.at(PATH)
    ids = np.array(LIBRARY.encode(text), dtype=np.int64)
    normalised, source = model.normalizer.normalize(text.encode())
    assert len(source) == len(normalised) + 1
    done = np.cumsum(model.lengths[ids])
    begins, ends = model.spans(pa.array([text]), ids, np.array([len(ids)]))
    assert source[done].tolist() == ends.tolist()
    assert source[done - model.lengths[ids]].tolist() == begins.tolist()


def character_map(pairs: dict[bytes, bytes]) -> bytes:
    """A compiled map with a naive double array: every node gets a block of 256 units of its own."""
    values, place = b"", {}
    for value in sorted(set(pairs.values())):
        place[value] = len(values)
        values += value + b"\0"
    nodes = {b""} | {k[:i] for k in pairs for i in range(1, len(k) + 1)}
    block = {n: 256 * (i + 1) for i, n in enumerate(sorted(nodes))}
    units = [0] * (256 * (len(nodes) + 2))

    def offset(at: int, base: int) -> int:
        distance = at ^ base
        return distance << 10 if distance < 1 << 21 else (distance >> 8) << 10 | 0x200

    units[0] = offset(0, block[b""])
    for node in sorted(nodes):
        for own in sorted(n for n in nodes if len(n) == len(node) + 1 and n.startswith(node)):
            at = block[node] ^ own[-1]
            units[at] = offset(at, block[own]) | own[-1] | (0x100 if own in pairs else 0)
            if own in pairs:
                units[block[own]] = place[pairs[own]] | 0x80000000
    blob = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(blob)) + blob + values


def normalizer(pairs, **spec):
    base = {"add_dummy_prefix": True, "remove_extra_whitespaces": False, "escape_whitespaces": True}
    return pieces.Normalizer(SimpleNamespace(precompiled_charsmap=character_map(pairs) if pairs else b"", **(base | spec)))


def test_longest_prefix_wins():
    made = normalizer({b"a": b"x", b"ab": b"yy", b"abcd": b"", "é".encode(): b"e", b"\t": b" "})
    out, source = made.normalize("abcaabcdé\tz".encode())
    assert out.decode() == "▁yycxe▁z"
    assert source.tolist() == [0, 0, 0, 0, 0, 2, 3, 8, 10, 10, 10, 11, 12]


def test_white_space_is_trimmed():
    made = normalizer({b"\t": b" "}, remove_extra_whitespaces=True)
    out, source = made.normalize(b" \t a  b ")
    assert out.decode() == "▁a▁b" and source.tolist() == [3, 3, 3, 3, 4, 4, 4, 6, 7]
    assert made.normalize(b" \t ")[0] == b"" and made.normalize(b"")[0] == b""


def test_odd_rows(spark, odd):
    rows = pieces.encode(odd, PATH).collect()
    assert len(rows) == odd.count() and set(rows[0].asDict()) == {*odd.columns, "ids", "begins", "ends", "decoded"} - {"text"}
    texts = {(r["doc_id"], r["n_chars"]): r["text"] or "" for r in odd.collect()}
    for r in rows:
        text = texts[r["doc_id"], r["n_chars"]]
        assert r["ids"] == LIBRARY.encode(text) and r["decoded"] == LIBRARY.decode(r["ids"])
        check_spans(text, r["ids"], r["begins"], r["ends"])
    back = pieces.decode(pieces.encode(odd, PATH, spans=False, decoded=False), PATH).collect()
    assert sorted(r["decoded"] for r in back) == sorted(r["decoded"] for r in rows)


def test_empty_table(empty):
    assert pieces.encode(empty, PATH).count() == 0


def test_clashing_columns(spark):
    rows = pieces.encode(spark.createDataFrame([("a b", 1, "x")], "text string, ids int, decoded string"), PATH).collect()
    assert rows[0]["ids"] == LIBRARY.encode("a b") and rows[0]["decoded"] == "a b"


def test_query(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op4_sentencepiece"](spark, SMALL).collect()}
    assert len(rows) == documents.num_rows
    for doc_id, text in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True):
        ids = LIBRARY.encode(text or "")
        assert rows[doc_id]["n_tokens"] == len(ids)
        assert rows[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id]["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_whole_texts_where_chunks_are_unsafe():
    assert pieces._crosses("a▁b") and pieces._crosses("it's") and pieces._crosses("\nx") and not pieces._crosses("▁▁the") and not pieces._crosses("),")
    model = pieces.Model(PATH)
    model.chunks = None
    ids, counts = model.encode(pa.array(ODD_TEXTS, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts))[:-1]] == [LIBRARY.encode(t or "") for t in ODD_TEXTS]
