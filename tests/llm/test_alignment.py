"""Token alignment against the libraries and plain loops over documents."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from proxylens.llm import alignment


def plain_report(rows):
    a_lib = Tokenizer.from_file(alignment.located(alignment.BYTE_BPE))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=alignment.located(alignment.PIECES))
    letters = alignment.byte_letters()
    counts, found = Counter(), []
    for doc_id, text in rows:
        a = a_lib.encode(" " + text, add_special_tokens=False) if text else None
        tokens_a = [(i, bytes(letters[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)] if text else []
        tokens_b = []
        for i in b_lib.encode(text) if text else []:
            p = b_lib.id_to_piece(i)
            tokens_b.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
        if not text or any(b"".join(x for _, x in t) != (" " + text).encode() for t in (tokens_a, tokens_b)):
            found.append((doc_id, 0, 0, [], []))
            continue
        ends = [dict(), dict()]
        for side, tokens in enumerate((tokens_a, tokens_b)):
            at = 0
            for k, (_, x) in enumerate(tokens):
                at += len(x)
                ends[side][at] = k
        groups, links, last = [], [], (-1, -1)
        for at in sorted(set(ends[0]) & set(ends[1])):
            now = (ends[0][at], ends[1][at])
            groups.append("|".join(",".join(str(i) for i, _ in t[lo + 1 : hi + 1]) for t, lo, hi in zip((tokens_a, tokens_b), last, now, strict=True)))
            links.append((tokens_a[now[0]][0], tokens_b[now[1]][0]))
            last = now
        counts.update(links)
        found.append((doc_id, len(tokens_a), len(tokens_b), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(i, n_a, n_b, len(g), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, n_a, n_b, g, links in found]


ODD = ["<|endoftext|> <s> a </s> <unk> <0x41>", "▁ x", "a\x00b", "é ﬁ ① \U0001f600\U0001f1e9\U0001f1ea", "  two  spaces   ", "\t\n tab\r\n", "x" * 300, "it's we'LL don't", "　 wide", "12345678 ١٢", "한글 日本語 русский"]


def test_query_equals_plain_loops(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = [(-1, None), (-2, ""), (None, "Hello World"), *((10_000 + i, t) for i, t in enumerate(ODD * 2)), (20_000, ODD[0])]
    got = alignment.alignment_report(docs.union(spark.createDataFrame(extra, "doc_id long, text string")))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + extra
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, plain_report(rows)))


def test_rare_pairs_through_the_shuffle(spark, small, monkeypatch):
    """With few pairs broadcast the others give the same measures."""
    texts = alignment.aligned_texts(spark.read.parquet(f"{small}/documents.parquet"))
    counts = alignment.pair_counts(texts)
    want = sorted(map(tuple, alignment.text_measures(texts, counts).collect()))
    monkeypatch.setattr(alignment, "MOST_PAIRS", 50)
    assert want == sorted(map(tuple, alignment.text_measures(texts, counts).collect())) and want


def test_byte_side_equals_the_library_on_random_strings():
    rng = np.random.default_rng(3)
    marks = list("abcXYZ019 '.,!?-_<|>\n\t\r") + ["'s", "'ll", "  ", "é", "ß", "é", "中", "\U0001f600", " ", " ", "٤", "‍", "<|endoftext|>"]
    texts = ["".join(marks[i] for i in rng.integers(0, len(marks), int(rng.integers(1, 40)))) for _ in range(3000)]
    lib = Tokenizer.from_file(alignment.located(alignment.BYTE_BPE))
    lib.encode_special_tokens = True
    assert alignment.byte_side(alignment.located(alignment.BYTE_BPE)).encode(texts) == [e.ids for e in lib.encode_batch([" " + t for t in texts], add_special_tokens=False)]
