import json

import pyarrow.parquet as pq

from blockmill.__main__ import main
from blockmill.plans.build import shards_of
from blockmill.sources import scan_packed


def test_build_resume_audit_read(spark, small, tmp_path, capsys):
    sources = json.dumps([
        {"name": "docs", "dataset": "documents.parquet", "config": None, "text_col": "text",
         "weight": 0.9, "token_cap": None},
        {"name": "web", "dataset": "pages.parquet", "config": None, "text_col": "html",
         "weight": 0.1, "token_cap": 20000},
    ])
    out = f"{tmp_path}/out"
    common = ["--out_dir", out, "--sources_json", sources, "--seq_len", "128", "--base", small,
              "--blocks_per_shard", "100", "--doc_id", "docs=doc_id", "--doc_id", "web=page_id"]
    main(["build", *common, "--total_tokens", "50000"])
    main(["build", *common, "--total_tokens", "120000", "--resume"])
    assert scan_packed(spark, shards_of(out)).count() == -(-120000 // 128)
    main(["audit", "--out_dir", out, "--seq_len", "128"])
    main(["steps", "--out_dir", out, "--seq_len", "128", "--micro_batch_size", "4", "--world", "2"])
    text = capsys.readouterr().out
    assert "blocks=938" in text and "no file" not in text and "118" in text
    read = ["--packed_dir", shards_of(out), "--seq_len", "128", "--world", "2",
            "--vocab_size", "257", "--pad_id", "256"]
    main(["rows", *read, "--output_dir", f"{tmp_path}/rows"])
    main(["batches", *read, "--micro_batch_size", "4", "--output_dir", f"{tmp_path}/batches"])
    assert pq.read_table(f"{tmp_path}/rows", columns=["labels"]).num_rows == 938
    assert spark.read.parquet(f"{tmp_path}/batches").selectExpr("sum(size(labels))").first()[0] == 938
