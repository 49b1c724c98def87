"""Command line for the common flows (``python -m titlecorpus <command>``).

    build    JSON-lines dump -> papers table (filter, first / random N, show K)
    train    papers table -> split -> fit + save model -> held-out loss + examples
    shards   papers table -> encoded training shards per split
    evaluate saved model on an exact 0.9 sample: k random true vs predicted titles
    predict  request files (id, abstract) -> titles, as a stream (availableNow)

Paths may be any Hadoop path; intermediate state goes to spark.checkpoint.dir.
"""

from __future__ import annotations

import argparse
import json

from titlecorpus.operators.model import default_model_name
from titlecorpus.plans.corpus import build_corpus, dataset_name
from titlecorpus.plans.training import (evaluate_saved_model, file_pairs, train_and_evaluate,
                                        training_pairs, write_training_shards)
from titlecorpus.schema import TASK_PREFIX
from titlecorpus.session import get_session
from titlecorpus.streaming.predict import default_checkpoint, start_predict_stream


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="titlecorpus")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--input", required=True)
    b.add_argument("--table-dir", required=True, help="folder that receives the named table")
    b.add_argument("--num-papers", type=int)
    b.add_argument("--cat-filter")
    b.add_argument("--random-select", action="store_true")
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--print-result", type=int, default=0)
    t = sub.add_parser("train")
    t.add_argument("--table", required=True)
    t.add_argument("--model-dir", required=True)
    t.add_argument("--model-name")
    t.add_argument("--limit", type=int, help="the first papers only (all)")
    t.add_argument("--eval-frac", type=float, default=0.1)
    s = sub.add_parser("shards")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--table")
    src.add_argument("--from-file", help="a .csv or .parquet export")
    s.add_argument("--n-rows", type=int)
    s.add_argument("--out", required=True)
    s.add_argument("--held-frac", type=float, default=0.1)
    s.add_argument("--vocab-size", type=int, help="the most frequent tokens only (all)")
    s.add_argument("--input-len", type=int, default=512)
    s.add_argument("--label-len", type=int, default=128)
    s.add_argument("--three-way", action="store_true")
    s.add_argument("--mask-pad", action="store_true")
    s.add_argument("--task-prefix", action="store_true", help="prefix inputs with the task prefix")
    e = sub.add_parser("evaluate")
    e.add_argument("--table", required=True)
    e.add_argument("--model", required=True)
    e.add_argument("--limit", type=int, help="the first papers only (all)")
    e.add_argument("--frac", type=float, default=0.9)
    e.add_argument("--show", type=int, default=5)
    p = sub.add_parser("predict")
    p.add_argument("--model", required=True)
    p.add_argument("--requests", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", help="the stream's checkpoint folder (<out>/_checkpoint)")
    p.add_argument("--max-length", type=int, default=128)
    p.add_argument("--source-format", choices=("parquet", "json"), default="parquet")
    for cmd in (t, e, p):
        cmd.add_argument("--beams", type=int, default=1, help="candidates a title (the best is evaluated)")
        cmd.add_argument("--no-repeat-ngram-size", type=int, choices=(0, 2), default=0)
    for cmd in (t, e):
        cmd.add_argument("--task-prefix", action="store_true", help="prefix evaluated inputs with the task prefix")
    a = ap.parse_args(argv)

    spark = get_session()
    if a.cmd == "build":
        table = f"{a.table_dir}/{dataset_name(a.num_papers, a.cat_filter)}"
        res = build_corpus(spark, a.input, table, a.num_papers, a.random_select, a.cat_filter,
                           a.seed, print_result=a.print_result)
        if res["display"]:
            print(res["display"])
        print(json.dumps({"table": table, "inserted": res["inserted"], "found": res["found"]}))
    elif a.cmd == "train":
        path = f"{a.model_dir}/{a.model_name or default_model_name()}"
        out = train_and_evaluate(spark, training_pairs(spark, a.table, a.limit), path, a.eval_frac,
                                 num_beams=a.beams, no_repeat_ngram_size=a.no_repeat_ngram_size,
                                 prefix=TASK_PREFIX if a.task_prefix else None)
        out["shown"].show(truncate=False)
        print(json.dumps({"model": path, "eval_loss": out["eval_loss"], **out["totals"]}))
    elif a.cmd == "shards":
        pairs = (file_pairs(spark, a.from_file, a.n_rows) if a.from_file
                 else training_pairs(spark, a.table, a.n_rows))
        write_training_shards(spark, pairs, a.out, a.held_frac, vocab_size=a.vocab_size,
                              input_len=a.input_len, label_len=a.label_len,
                              mask_pad=a.mask_pad, three_way=a.three_way,
                              prefix=TASK_PREFIX if a.task_prefix else None)
    elif a.cmd == "evaluate":
        shown = evaluate_saved_model(spark, training_pairs(spark, a.table, a.limit), a.model,
                                     a.frac, n_show=a.show, num_beams=a.beams,
                                     no_repeat_ngram_size=a.no_repeat_ngram_size,
                                     prefix=TASK_PREFIX if a.task_prefix else None)
        shown.orderBy("draw").show(truncate=False)
    elif a.cmd == "predict":
        q = start_predict_stream(spark, a.requests, a.model, None, a.out,
                                 default_checkpoint(spark, a.out, a.checkpoint), a.max_length,
                                 source_format=a.source_format, num_beams=a.beams,
                                 no_repeat_ngram_size=a.no_repeat_ngram_size)
        q.awaitTermination()


if __name__ == "__main__":
    main()
