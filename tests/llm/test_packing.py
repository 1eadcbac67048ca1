import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm.packing import TokenIds, pack_documents, plan_best_fit

from .data import empty, odd, odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(counts, capacity):
    """Best-fit decreasing, a piece at a time: the rooms that are left."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [r for r in rooms if r >= length]
            room = min(fitting) if fitting else capacity
            if fitting:
                rooms.remove(room)
            rooms.append(room - length)
    return Counter(rooms)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_is_best_fit(counts):
    sequences = {}
    covered = {length: set() for length in counts}
    for length, first_rank, ranks, first, offset in plan_best_fit(counts, 30):
        for i in range(ranks):
            assert first_rank + i not in covered[length]
            covered[length].add(first_rank + i)
            sequences.setdefault(first + i, []).append((offset, length))
    assert all(covered[n] == set(range(counts[n])) for n in counts)
    rooms = []
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        rooms.append(30 - end)
    assert min(rooms, default=0) >= 0
    assert Counter(rooms) == one_by_one(counts, 30)


def expected_pieces(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    found = Counter()
    for key, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[start : start + capacity], "<u4")
            found[key, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    return found


@pytest.mark.parametrize("capacity", [64, 2048])
def test_odd_rows(spark, capacity):
    table = odd(spark, length=5, sequence_id="x", piece=1, of_group=2)
    rows = pack_documents(table, PATH, capacity=capacity).collect()
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == expected_pieces(odd_rows(), capacity)
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= capacity


def test_ids_of_words_are_those_of_the_text():
    rng = random.Random(1)
    signs = ["a", "Ab", "é", "É", "e\u0301", "1", "²", "Ⅷ", ".", ",", "!", "'", "s", "'s", "'LL", "#", "<|endoftext|>", "<|ENDOFTEXT|>"]
    signs += ["İ", "ẞ", "Σ", "ς", "ﬁ", "𝄞", "中", "\u0301", "\u037e", "\x85", "\x1c", "\u200b", "\xa0", " ", "\n", "\t", "\x00"]
    whole, known = Tokenizer.from_file(PATH), TokenIds(PATH, most=3000)
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randrange(1, 14)))
        words = known.words(text.encode())
        known.learn([words])
        ids = np.frombuffer(known.of(words), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_ids_of_many_texts():
    rng = random.Random(2)
    signs = ["a", "Ab", "z", "thé", "É", "ß", "×", "÷", "日", "1", "$$$", "###", "=", "<", ">", "`", "_", "@", "(", "-", ".", "'", "'s"]
    signs += ["\u0338", "\u0301", "\x1c", "\x85", "\u2003", "<|endoftext|>", "<|EndOfText|>", " ", "  ", "\n", "\t"]
    texts = [None, "", " ", *("".join(rng.choices(signs, k=rng.randrange(1, 14))) for _ in range(3000)), ""]
    whole, known = Tokenizer.from_file(PATH), TokenIds(PATH, most=3000)
    for i in range(0, len(texts), 500):
        own = texts[i : i + 500]
        ids, borders = known.of_texts([x and x.encode() for x in own], b"\0\0\0\0")
        assert len(borders) == len(own) + 1 and borders[-1] == len(ids)
        for text, first, last in zip(own, borders, borders[1:], strict=False):
            expected = whole.encode(text or "", add_special_tokens=False).ids + [0]
            assert ids[first:last].tolist() == expected, text


def test_signs_behind_a_word_do_not_make_another():
    known = TokenIds(PATH)
    before = len(known)
    known.of_texts(["".join(f"{x}{s} " for x in ("thé", "house") for s in ("$$$", "###", "&&&", "%%%", ".", "")).encode()], b"\0" * 4)
    assert len(known) - before <= 2 + 5 + 1


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises(ValueError, match="word by word"):
        TokenIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty(spark):
    assert pack_documents(empty(spark), PATH).count() == 0
