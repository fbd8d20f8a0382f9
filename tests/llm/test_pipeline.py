import corpus_pipeline
from test_search_operators import plain_discovery, plain_line_dedup, plain_simhash
from test_text_operators import check_packing, plain_rules

from quillmark.llm import common, packing, pii


def test_pipeline_against_plain_stages(spark, docs):
    rows = {r.doc_id: r.text for r in docs.collect() if plain_rules(r.text)["kept"]}
    rows = {i: t for i, (t, _) in plain_line_dedup(sorted(rows.items()), near=True, short=True).items()}
    keep = {c for _, _, c in plain_simhash(sorted(rows.items()))}
    spans = plain_discovery([(i, t) for i, t in rows.items() if i in keep])
    rows = {i: pii.replace_spans(rows[i], s) for i, s in spans.items()}
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    check_packing(out, 4096)
    mine = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.piece)):
        mine[r.doc_id] = mine.get(r.doc_id, b"") + bytes(r.ids)
    assert mine == {i: packing.encode(corpus_pipeline.PIECES, [t.encode()])[0] for i, t in rows.items()}


def test_stages_keep_columns_and_take_odd_rows(spark, odd, empty):
    for table in (odd, empty):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001")
            if name != "best_fit_packing":
                assert docs.columns == table.columns
        docs.count()


def test_a_run_leaves_its_result_only(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [p.name for p in tmp_path.iterdir()]
    assert len(left) == 1 and left[0].startswith("quillmark-pipeline-best_fit_packing") and out.count() > 0
    common.forget(docs)
    common.forget(out)
    assert not list(tmp_path.iterdir()) and docs.count() > 0
