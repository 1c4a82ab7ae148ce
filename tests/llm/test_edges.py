"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import public_tokenizers
import pytest

import corpus_pipeline
from vitrine.llm import decontamination, html, language, mixing, neardup, pii, quality, secrets, sharding, tokens

# columns of other inputs' and of the results' names
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, key string, label string, place long, "
    "target double, shard_id string, kept boolean, row string, spans string, `odd name.x` string, slot long, of string"
)
EXTRA = (1, "k", "l", 2, 0.5, "s", True, "r", "p", "o", 3, "of")
PROSE = "One line of text that is long enough to count as one, with words that do not repeat at all here and now."
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "", 0),
    (3, PROSE, "en", "a", 9),
    (3, PROSE, "en", "a", 9),
    (None, PROSE + " And one more sentence ends it.", None, "a", 9),
    (4, " \n\t\n ", "en", "b", 9),
    (5, "Wort für Wort steht hier ein langer Satz, der nichts sagt, aber gut genug ist für das, was wir damit wollen.", "de", None, 9),
    (6, "lone", "de", "b", 9),
    (7, "x" * 200_000 + " " + "long words " * 20_000, "en", "a", 9),
    (8, "1" * 50_000 + " token=" + "a" * 50_000, "en", "b", 9),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(None, PROSE), (1, None), (2, ""), (3, PROSE), (3, PROSE)], "item_id long, text string")


OPERATORS = {
    "pii": pii.find_pii,
    "mix": mixing.mix,
    "near": neardup.near_duplicates,
    "quality": quality.quality_rules,
    "secrets": secrets.find_secrets,
    "shard": sharding.shard,
    "tokens": lambda d: tokens.count_tokens(d, public_tokenizers.path("piece_bpe_32k.model")),
    "language": language.identify,
    "html": lambda d: html.extract_text(d, ("doc_id", "source"), "text"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_a_document(docs, name):
    found = OPERATORS[name](docs).collect()
    assert sorted(str(r[0]) for r in found) == sorted(str(r[0]) for r in ROWS)
    assert len({tuple(r) for r in found if r[0] == 3}) == 1  # repeated rows, repeated results


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(none, docs, name):
    df = OPERATORS[name](none)
    assert df.collect() == [] and df.columns == OPERATORS[name](docs).columns


def test_results_for_nulls(docs):
    by = lambda df: {r[0]: r for r in df.collect()}
    assert by(pii.find_pii(docs))[1].spans == "" and by(secrets.find_secrets(docs))[1].spans == ""
    assert by(mixing.mix(docs))[1].taken == 0 and by(mixing.mix(docs))[2].size == 0
    assert by(language.identify(docs))[1].lang_pred == "und" and by(language.identify(docs))[4].lang_pred == "und"
    assert by(quality.quality_rules(docs))[1].kept is False
    assert by(OPERATORS["tokens"](docs))[1].n_tokens == 0 == by(OPERATORS["tokens"](docs))[2].n_tokens
    near = by(neardup.near_duplicates(docs))
    assert near[1].class_id == 1 and near[3].class_size == 2


def test_finds(docs, items, none):
    found = decontamination.find_items(docs, items).collect()
    assert sorted((r.doc_id, r.item_id is None) for r in found if r.doc_id) == [(3, False), (3, False), (3, True), (3, True)]
    assert decontamination.find_items(none, items).collect() == []
    assert decontamination.find_items(docs, items.limit(0)).collect() == []


def test_stages_keep_columns(spark, docs, none, items, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (docs, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == frame.columns and [f.dataType for f in out.schema] == [f.dataType for f in frame.schema], name
            out.collect()
        out = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path))
        assert out.count() == frame.count() and {"shard_id", "shard_bytes", "shard_docs"} <= set(out.columns)


def test_dedup_stage_keeps_one_row_of_a_class(docs):
    kept = neardup.distinct_documents(docs).collect()
    assert sum(r.text == PROSE for r in kept) == 1
    assert sum(r.text is None for r in kept) == 2
    assert {4, 5, 6, 7, 8} <= {r.doc_id for r in kept}


def test_a_hot_source_and_ties(spark):
    rows = [(k % 3 if k < 300 else k, f"word{k % 7} " * (1 + k % 5), None, "hot" if k % 3 else f"s{k % 4}", 0) for k in range(900)]
    docs = spark.createDataFrame([r + EXTRA for r in rows], SCHEMA)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == 900 and all(0 <= r.taken <= 2 * r.size for r in mixed)
    shards = sharding.shard(docs, limit=400).collect()
    size = {}
    for r in shards:
        size[r.shard_id] = size.get(r.shard_id, 0) + r.bytes
    assert all(size[r.shard_id] == r.shard_bytes for r in shards)
    over = {r.shard_id for r in shards if r.shard_bytes > 400}
    assert all(len({r.doc_id for r in shards if r.shard_id == s}) == 1 for s in over)  # one place each
    ids = sorted({(r.shard_id, r.depth) for r in shards})
    assert not any(b.startswith(a) and a != b for a, _ in ids for b, _ in ids)
