"""Aligned tokens against a plain walk over both token lists."""

import bisect
import hashlib
from collections import Counter, defaultdict

import pytest

from fieldlens.llm import alignment
from tests_llm_rows import COLUMNS, awkward_rows


@pytest.fixture(scope="module")
def tokens():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    letters = alignment.byte_letters()

    def both(text):
        if not text:
            return [], []
        of_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        want = (" " + text).encode()
        return (of_a, of_b) if b"".join(x for _, x in of_a) == want == b"".join(x for _, x in of_b) else ([], [])

    return both


def ranges(tokens):
    out, end = [], 0
    for i, x in tokens:
        out.append((end, end + len(x), i))
        end += len(x)
    return out


def plain(tokens, texts):
    """Measures of each text of a list."""
    rows, counts = [], Counter()
    for text in texts:
        a, b = (ranges(t) for t in tokens(text))
        links, k = [], 0
        for s, e, i in a:
            while k and b[k - 1][1] > s:
                k -= 1
            while b[k][1] <= s:
                k += 1
            n = k
            while n < len(b) and b[n][0] < e:
                links.append((i, b[n][2]))
                n += 1
        counts.update(links)
        common = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [defaultdict(list), defaultdict(list)]
        for g, side in zip(groups, (a, b)):
            for _, e, i in side:
                g[bisect.bisect_left(common, e)].append(str(i))
        said = ";".join(",".join(groups[0][n]) + "|" + ",".join(groups[1][n]) for n in range(len(common)))
        rows.append((len(a), len(b), len(common), links, hashlib.sha256(said.encode()).hexdigest() if a else ""))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(n_a, n_b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha) for n_a, n_b, g, links, sha in rows], counts


def of(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def test_op13_on_the_small_table(spark, small_dir, tokens):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    want, _ = plain(tokens, list(docs.values()))
    got = {r.doc_id: of(r) for r in alignment.op13_cross_tokenizer(spark, small_dir).collect()}
    assert got == dict(zip(docs, want))


def test_awkward_rows(spark, tokens):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, COLUMNS).withColumnsRenamed({"lang": "block", "source": "links"})
    found, pairs = alignment.align(df, block_bytes=300)
    want, counts = plain(tokens, [r[1] for r in rows])
    assert Counter((r.id, *of(r)) for r in found.collect()) == Counter((r[0], *w) for r, w in zip(rows, want))
    got = {(r.a, r.b): (r["count"], r.is_best) for r in pairs.collect()}
    assert {k: n for k, (n, _) in got.items()} == counts
    assert all(is_best == (n == max(m for (_, y), m in counts.items() if y == b)) for (_, b), (n, is_best) in got.items())


def test_tables_without_tokens(spark):
    assert alignment.align(spark.createDataFrame([], COLUMNS))[0].collect() == []
    got = alignment.align(spark.createDataFrame([(1, None, "", "", 0), (None, "", "", "", 0), (3, "▁", "", "", 0)], COLUMNS))[0].collect()
    assert Counter((r.id, *of(r)) for r in got) == Counter((i, 0, 0, 0, 0, 0, 0, "") for i in (1, None, 3))


def test_byte_letters_cover_all_bytes():
    assert sorted(alignment.byte_letters().values()) == list(range(256))
