"""The pipeline against its stages written in plain Python, and the registration of the queries."""

import __spark_entry__ as entry
import corpus_pipeline
from broadsheet.llm import quality
from helpers import frame, prose
from test_copies import corpus, plain_classes, plain_exact, plain_removed


def plain_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.encode_special_tokens = True
    return [*made.encode(text, add_special_tokens=False).ids, 0]


def test_stages_follow_each_other(spark, tmp_path):
    shared = prose(70, 90)
    texts = corpus() + [prose(200 + k, 70) + " " + shared for k in range(4)] + [" ".join(w + "$$$" for w in prose(300, 90).split())]
    docs = frame(spark, texts, clashing=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    rows = [(i, t) for i, t in enumerate(texts) if i in good]
    rows = [(i, t) for i, t in rows if plain_exact(rows)[i][2]]
    rows = [(i, t) for i, t in rows if plain_classes(rows, 5, 80)[i][1] == i]
    cut = plain_removed(rows, 13)
    split = {i: (t.split(), cut[i]) for i, t in rows}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(split) and len(split) < len(good) < len(texts)
    assert any(n_removed for _, (_, n_removed, _) in split.values())
    for i, (words, (n_words, n_removed, _)) in split.items():
        own = sorted((r.piece, r.length) for r in got if r.doc_id == i)
        if not n_removed:
            ids = plain_ids(dict(rows)[i])
            assert sum(n for _, n in own) == len(ids)
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in parts) <= 2048 for parts in used.values())


def test_pipeline_of_an_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_join", "substring_dedup", "best_fit_packing"]
