"""Token counts against the tokeniser itself; segmentations against listing all of them."""

import collections
import math

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from waymeter.llm import pieces, tokens

TEXTS = ["", None, " ", "a", "  a  b ", "\n\n x\n", "é🙂\t\x00中文字 ﬁ", "it's <|endoftext|> x", "ab1 " * 20_000, "x" * 70_000, "a b c\r\n" * 30, "same", "same"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i % 12, t, i) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, n_tokens int")


def test_counts_equal_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        text = row.text or ""
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False)) and row.n_bytes == len(text.encode())
        assert row.over_limit == (row.n_tokens > 512)


def test_long_runs_of_one_character(spark):
    """One row of one character must not end the job."""
    runs = {" " * 1_000_000: 1_000_000, "\n" * 1_000_000: None, "a" * 1_000_000: None, "7" * 1_000_000: None, "a1 -" * 250_000: None}
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "doc_id bigint, text string")
    found = {r.doc_id: r.n_tokens for r in tokens.count_tokens(rows, path).collect()}
    assert found == {i: len(library.encode(t, add_special_tokens=False)) if n is None else n for i, (t, n) in enumerate(runs.items())}


def test_other_vocabularies_give_their_counts(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert all(row.n_tokens == len(model.encode(row.text or "")) for row in rows)


def test_empty_table(docs):
    assert tokens.count_tokens(docs.limit(0), public_tokenizers.path("byte_bpe_50k.tiktoken")).count() == 0
    assert pieces.encode_documents(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_encoding_equals_the_library_and_decodes(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), k=3).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        text = row.text or ""
        assert row.ids == model.encode(text) and row.n_pieces == len(row.ids) and row.decoded_equal
        assert len({tuple(s.ids) for s in row.samples}) == len(row.samples) == min(3, len(row.samples))
        assert all(model.decode(s.ids) == text for s in row.samples)
        values = [s.perturbed for s in row.samples]
        assert values == sorted(values, reverse=True)
    by_text = collections.defaultdict(set)
    for row in rows:
        by_text[row.doc_id, row.text].add(tuple(s.digest for s in row.samples))
    assert all(len(x) == 1 for x in by_text.values())


def test_space_mark_in_a_text_is_reported(spark):
    odd = spark.createDataFrame([(1, "▁x")], "doc_id bigint, text string")
    assert not pieces.encode_documents(odd, public_tokenizers.path("piece_bpe_32k.model")).first().decoded_equal


def test_other_columns_stay(spark):
    rows = [(1, "the cat", "a", "b", 5), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _pieces string, _pieces_ string, n_pieces int")
    found = {r.doc_id: r for r in pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert (found[1]._pieces, found[1]._pieces_, found[1].n_pieces) == ("a", "b", len(found[1].ids))
    assert found[2].n_pieces == 0 and found[2]._pieces is None and found[2].samples == []


def all_paths(lattices, at):
    first, following, piece, log_c = lattices.first, lattices.next, lattices.piece, lattices.log_c

    def ways(node):
        for e in range(first[node], first[node + 1]):
            for path, log_p in [((), 0.0)] if following[e] < 0 else ways(following[e]):
                yield (piece[e], *path), log_c[e] + log_p

    found = [((), 0.0)]
    for unit in at:
        found = [(a + b, x + y) for a, x in found for b, y in ways(lattices.roots[unit])]
    return dict(found)


def test_samples_have_the_right_distribution():
    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    at = lattices.encode(["the cat"])[0]
    paths = all_paths(lattices, at)
    assert math.isclose(sum(map(math.exp, paths.values())), 1.0)
    n = 6000
    first, weighted = collections.Counter(), collections.Counter()
    for found, after in pieces.sample(lattices, [at] * n, [i * 7919 for i in range(n)], 3):
        chosen = [tuple(p.tolist()) for p, _, _ in found]
        assert len(set(chosen)) == 3 and all(abs(paths[c] - log_p) < 1e-9 for c, (_, log_p, _) in zip(chosen, found))
        first[chosen[0]] += 1
        for c, (_, log_p, _) in zip(chosen, found):
            weighted[c] += math.exp(log_p - pieces.log_inclusion(log_p, after))
    for path in sorted(paths, key=paths.get)[-4:]:
        p = math.exp(paths[path])
        assert abs(first[path] / n - p) < 5 * math.sqrt(p / n)
        # weighting by inclusion undoes the selection
        assert abs(weighted[path] / n - p) < 0.05 * p + 0.01


def test_all_segmentations_of_a_small_text():
    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    at = lattices.encode(["the cat"])[0]
    ((found, after),) = pieces.sample(lattices, [at], [5], 1000)
    assert {tuple(p.tolist()) for p, _, _ in found} == set(all_paths(lattices, at)) and after == -math.inf


def test_units_tell_whether_a_text_decodes_and_what_its_pieces_are():
    """Counts, decoding and ids of pieces from what is known of units equal the model's own, spelled characters included."""
    import numpy as np
    import public_tokenizers

    from waymeter.llm import pieces

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    odd = ["", " ", "  a  b ", "▁", "a▁b", "a\n\n b\t\x00", "漢字 😀😀a é", "\n", "Ω​ one two"]
    for text, at in zip(odd, lattices.encode(odd)):
        own = lattices.model.encode(text)
        assert lattices.count(at) == len(own), text
        assert lattices.decodes(text, at) == (lattices.model.decode(own) == text), text
    spelled = lattices.piece_ids(np.array([5, -1 - ord("é"), 7, -1 - ord("😀")])).tolist()
    assert spelled == [5, *[lattices.byte[b] for b in "é".encode()], 7, *[lattices.byte[b] for b in "😀".encode()]]


def test_query_gives_ids_that_the_model_decoded(spark, tmp_path):
    """The ids of each text and of its samples are in the result, and each text's ids went through the model's decoder."""
    import sentencepiece

    from waymeter.llm import queries

    texts = ["the cat sat", "漢字 é\n  two", "", None, "a▁b"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in queries.op1_sentencepiece(spark, str(tmp_path)).collect():
        text = texts[row.doc_id] or ""
        assert row.ids == model.encode(text) and row.n_pieces == len(row.ids)
        assert row.decoded_equal == (model.decode(row.ids) == text)
        assert [len(ids) for ids in row.sample_ids] == row.sample_pieces
        assert all(model.decode(ids) == text.replace("▁", " ") for ids in row.sample_ids)

    lattices = pieces.Lattices(public_tokenizers.path("piece_bpe_32k.model"))
    asked, own = [], lattices.model

    class Watched:
        def __getattr__(self, name):
            return getattr(own, name)

        def decode(self, ids, **options):
            asked.append(list(ids))
            return own.decode(ids, **options)

    lattices.model = Watched()
    at = lattices.encode(["the cat sat on the cat"])[0]
    assert lattices.decodes("the cat sat on the cat", at) and asked == [own.encode("the cat sat on the cat")]
