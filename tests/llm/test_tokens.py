"""Token counts and the alignment of two tokenizers against the libraries and plain Python."""

import hashlib
import sys
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tokenwin.llm import alignment, tokencount
from tokenwin.llm.tables import table

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "  lead", "tail  ", "one space ", "a\n  b", "x<|endoftext|> y <|endoftext|>", "it's 'tis we'll", "▁ a▁b", "漢字 かな 123 456", "a  b   c",
    "é è ×÷ é1", "\t\t\n x\r\n\r\ny  \n", "<s> </s> <0x41>", "\x00 \x01a", " ", "\n", "é 　 x   y  z", " 12 3 4a b5!? ...a",
    "a b " * 3000, "x" * 5000, None, "", "same text", "same text", "<|endoftext|>", "ends in é é \U0001f600 b",
]


@pytest.fixture
def texts(spark):
    """Whole documents and odd texts, beside columns whose names the operators use."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    more = spark.createDataFrame([(*r, 5, "a") for r in rows], "doc_id bigint, text string, n_tokens int, a string")
    return dict(rows), more


def test_token_counts_equal_the_library(spark, texts):
    rows, docs = texts
    library = Tokenizer.from_file(BYTES)
    counts = tokencount.count_tokens(docs, BYTES)
    assert counts.columns == ["doc_id", "a", "n_bytes", "n_tokens", "over_limit"]
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in counts.collect()}
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows.items()}
    assert found == {i: (b, n, n > 512) for i, (b, n) in want.items()}


def test_counts_of_repeated_ids_and_of_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id bigint, text string")
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in tokencount.count_tokens(docs, BYTES).collect()) == [("1", 2), ("1", 2), ("None", 1)]
    assert tokencount.count_tokens(docs.where("doc_id > 5"), BYTES).collect() == []


def test_every_proved_string_is_one_token():
    with open(BYTES, encoding="utf-8") as file:
        proved = tokencount.proved_tokens(file.read())
    assert 40_000 < len(proved) == len(set(proved.tolist()))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokencount.described(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).to_str())


def plain_alignment(rows):
    a_library = Tokenizer.from_file(BYTES)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters, found, links_of, counts = tokencount.byte_of_letter(), {}, {}, Counter()
    for i, text in rows.items():
        a, b, want = [], [], (" " + (text or "")).encode()
        if text:
            encoded = a_library.encode(" " + text, add_special_tokens=False)
            a = [(k, bytes(letters[c] for c in t)) for k, t in zip(encoded.ids, encoded.tokens)]
            for k in b_library.encode(text):
                piece = b_library.id_to_piece(k)
                b.append((k, bytes([int(piece[3:5], 16)]) if b_library.is_byte(k) else piece.replace("▁", " ").encode()))
        if b"".join(v for _, v in a) != want or b"".join(v for _, v in b) != want:
            a = b = []
        end_a, end_b = ([0, *accumulate(len(v) for _, v in side)] for side in (a, b))
        links, at = [], 0
        for k in range(len(a)):
            while end_b[at + 1] <= end_a[k]:
                at += 1
            m = at
            while m < len(b) and end_b[m] < end_a[k + 1]:
                links.append((k, m))
                m += 1
        cuts = sorted(set(end_a[1:]) & set(end_b[1:]))
        group_a, group_b = ([sum(c <= e for c in cuts) for e in ends[:-1]] for ends in (end_a, end_b)) if len(a) < 2000 else ([], [])
        digest = None if len(a) >= 2000 else ""
        if a and digest == "":
            parts = [(",".join(str(x[0]) for x, g in zip(a, group_a) if g == n), ",".join(str(x[0]) for x, g in zip(b, group_b) if g == n)) for n in range(len(cuts))]
            digest = hashlib.sha256(";".join(f"{x}|{y}" for x, y in parts).encode()).hexdigest()
        found[i] = (len(a), len(b), len(cuts), len(links), digest, links, cuts)
        links_of[i] = [(a[k][0], b[m][0]) for k, m in links]
        counts.update(links_of[i])
    most = Counter()
    for (_, b_id), n in counts.items():
        most[b_id] = max(most[b_id], n)
    return {i: (*f, sum(counts[p] == most[p[1]] for p in links_of[i]), sum(counts[p] for p in links_of[i])) for i, f in found.items()}


@pytest.mark.parametrize("held", [alignment.HELD, 300, 1])
def test_alignment_equals_plain_python(spark, texts, held):
    rows, docs = texts
    want = plain_alignment(rows)
    for r in alignment.align(docs, BYTES, PIECES, held=held).collect():
        n_a, n_b, n_groups, n_links, digest, _, _, n_best, count_sum = want.pop(r["doc_id"])
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == (n_a, n_b, n_groups, n_links, n_best, count_sum)
        assert digest is None or r["groups_sha256"] == digest
    assert not want


def test_links_and_cuts_are_listed(spark, texts):
    rows, docs = texts
    want = plain_alignment(rows)
    vocabularies = alignment.read_vocabularies(BYTES, PIECES)
    for r in alignment.links_and_cuts(alignment.encode_both(docs, vocabularies), vocabularies).collect():
        assert [tuple(x) for x in r["links"]] == want[r["doc_id"]][5]
        assert r["cuts"] == want[r["doc_id"]][6]


def test_alignment_of_repeated_rows_and_of_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id bigint, text string")
    assert sorted((str(r["doc_id"]), r["n_links"], r["count_sum"]) for r in alignment.align(docs, BYTES, PIECES).collect()) == [
        ("1", 2, 5), ("1", 2, 5), ("None", 1, 3),
    ]
    assert alignment.align(docs.where("doc_id > 5"), BYTES, PIECES).collect() == []


def test_a_worker_gives_back_free_memory_before_it_goes_on(monkeypatch):
    from tokenwin.llm import spans

    given = []
    monkeypatch.setattr(spans, "release_free_memory", lambda: given.append(1))
    assert [spans.worker_memory(key, lambda: key) for key in ("a", "a", "b")] == ["a", "a", "b"] and len(given) == 2
    monkeypatch.undo()
    spans.release_free_memory()
    vars(sys)["_tokenwin_memory"].clear()


def test_workers_that_idle_or_code_blocks_hold_no_more_than_they_need(monkeypatch):
    import numpy as np

    from tokenwin.llm import spans, tokenfile

    spans.worker_memory("encoder", object)
    assert not list(tokenfile._blocks(iter([]), np.ones(4, np.uint8)))
    assert "_tokenwin_memory" not in vars(sys)
    given = []
    monkeypatch.setattr(spans, "_trim", lambda: given.append(1))
    rows = spans.releasing(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert [next(rows), next(rows)] == [2, 4] and not given
    assert list(rows) == [] and len(given) == 1
    assert spans.releasing_group(lambda table: table)(3) == 3 and len(given) == 2
