"""Round trips through the file connectors (TSV, text folder, runs, params)."""

import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import features
from shelfwise.sources import params, text_files, tsv
from shelfwise.fixed_values import RESOURCE_PREFIX as R


def _tmp():
    return tempfile.mkdtemp(prefix="shelfwise-io-")


def test_tsv_round_trip_awkward_strings(spark):
    rows = [
        (1, 2, 1, 'quote "x"', "tab\tinside"),
        (3, 4, 0, "line\nbreak", "  blanks  "),
        (5, 6, 1, "", None),
        (7, 8, 1, "NA", "ok"),
    ]
    df = spark.createDataFrame(rows, schemas.EXAMPLES)
    out = os.path.join(_tmp(), "ex")
    tsv.write_tsv(df.coalesce(1), out)
    back = {r["user_id"]: r for r in tsv.read_examples(spark, out).collect()}
    assert back[1]["user_genres"] == 'quote "x"' and back[1]["item_genre"] == "tab\tinside"
    assert back[3]["user_genres"] == "line\nbreak" and back[3]["item_genre"] == "  blanks  "
    # '' and NULL are both an empty field, read back as missing (pandas-like)
    assert back[5]["user_genres"] is None and back[5]["item_genre"] is None
    # pandas NA token
    assert back[7]["user_genres"] is None


def test_entity_file_skips_two_lines_and_keeps_order(spark):
    d = _tmp()
    with open(os.path.join(d, "mapping_entities.tsv"), "w") as f:
        f.write("id\tprop\n0\tjunk\n")
        f.write(f"7\t{R}b\n3\t{R}a\n")
    ents = tsv.read_entities(spark, os.path.join(d, "mapping_entities.tsv"))
    rows = sorted(ents.collect(), key=lambda r: r["seq"])
    assert [(r["id"], r["prop"], r["seq"]["line"]) for r in rows] == [(7, R + "b", 3), (3, R + "a", 4)]
    with open(os.path.join(d, "item_prop.tsv"), "w") as f:
        f.write("1\t3\t2\n1\t7\t2\n")
    ip = tsv.read_item_prop(spark, os.path.join(d, "item_prop.tsv"))
    f = features.item_features(ip, ents, entity_order="seq", triple_order="seq").collect()[0]
    # entity-file order decides: entity 7 (b) comes first although its id is larger
    assert f["author"] == "b"


def test_predictions_rank_is_line_order(spark):
    d = _tmp()
    for run, lines in {"run-a": ["1\t9", "1\t4", "2\t5"], "run-b": ["3\t1"]}.items():
        with open(os.path.join(d, f"{run}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
    got = {(r["run_name"], r["user_id"], r["item_id"]): r["rank"] for r in tsv.read_predictions(spark, d).collect()}
    assert got == {("run-a", 1, 9): 1, ("run-a", 1, 4): 2, ("run-a", 2, 5): 1, ("run-b", 3, 1): 1}


def test_ranked_predictions_written_per_run(spark):
    d = os.path.join(_tmp(), "results")
    df = spark.createDataFrame(
        [("r1", 1, 9, 2), ("r1", 1, 4, 1), ("r2", 2, 5, 1)], "run_name string, user_id long, item_id long, rank long"
    )
    tsv.write_ranked_predictions(df, d)
    assert sorted(os.listdir(d))[:2] == ["_SUCCESS", "run_name=r1"] or "run_name=r1" in os.listdir(d)
    back = spark.read.schema("user_id long, item_id long").option("sep", "\t").csv(os.path.join(d, "run_name=r1"))
    assert [tuple(r) for r in back.collect()] == [(1, 4), (1, 9)]


def test_text_folder(spark):
    d = _tmp()
    for name, text in {"10.text": "hello world", "11.text": "", "12.text": "bé"}.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    got = {r["item_id"]: r["item_text"] for r in text_files.read_text_folder(spark, d).collect()}
    assert got.get(10) == "hello world" and got.get(12) == "bé"
    assert got.get(11, "") == ""
    out = os.path.join(_tmp(), "texts")
    text_files.write_texts(text_files.read_text_folder(spark, d), out)
    assert text_files.read_texts(spark, out).where(F.col("item_id") == 10).count() == 1


def test_param_files(spark):
    d = _tmp()
    with open(os.path.join(d, "p-text.json"), "w") as f:
        json.dump({"template": "*item_text* *user_genres*", "mapping": "{0:'No', 1:'Yes'}"}, f)
    with open(os.path.join(d, "p-struct.json"), "w") as f:
        json.dump({"run_name": "s", "template": "*item_author*", "mapping": "{0: 'detest', 1: 'love'}"}, f)
    runs = {r.run_name: r for r in params.read_prompt_runs(spark, d)}
    assert runs["p-text"].kind == "text" and runs["p-text"].word_pos == "Yes"
    # a run is named after its file, whatever the file says
    assert runs["p-struct"].kind == "structured" and runs["p-struct"].word_neg == "detest"
    os.makedirs(os.path.join(d, "more"))
    with open(os.path.join(d, "more", "p-text.json"), "w") as f:
        json.dump({"template": "x", "mapping": "{0:'No', 1:'Yes'}"}, f)
    with pytest.raises(ValueError, match="p-text"):
        params.read_prompt_runs(spark, f"{d}/{{p-*.json,more/*.json}}")


def test_blank_lines_and_bad_ids(spark):
    d = _tmp()
    for name, body in (("good", "1\t2\t4\n\n  \n3\t5\t7\n"), ("bad", "1\t2\t4\nx\t2\t4\n"), ("short", "1\t2\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    good = tsv.read_item_prop(spark, os.path.join(d, "good")).orderBy("seq").collect()
    assert [(r["item_id"], r["id"], r["type"]) for r in good] == [(1, 2, 4), (3, 5, 7)]
    for name in ("bad", "short"):
        with pytest.raises(Exception, match="malformed line"):
            tsv.read_item_prop(spark, os.path.join(d, name)).collect()


def test_run_names_are_whole_and_decoded(spark):
    d = _tmp()
    for name in ("prompt-v1.2.txt", "prompt-v1.3.txt"):
        with open(os.path.join(d, name), "w") as f:
            f.write("1\t5\n1\t6\n")
    got = sorted((r["run_name"], r["rank"]) for r in tsv.read_predictions(spark, d).collect())
    assert got == [("prompt-v1.2", 1), ("prompt-v1.2", 2), ("prompt-v1.3", 1), ("prompt-v1.3", 2)]
    d = _tmp()
    df = spark.createDataFrame([("run a:b+c", 1, 9, 1)], "run_name string, user_id long, item_id long, rank long")
    tsv.write_ranked_predictions(df, d)
    assert [r["run_name"] for r in tsv.read_predictions(spark, os.path.join(d, "run_name=*")).collect()] == ["run a:b+c"]


def test_rerun_replaces_only_its_run(spark):
    d = os.path.join(_tmp(), "results")
    first = spark.createDataFrame(
        [("r1", 1, 9, 1), ("r2", 2, 5, 1)], "run_name string, user_id long, item_id long, rank long"
    )
    tsv.write_ranked_predictions(first, d)
    again = spark.createDataFrame([("r1", 1, 7, 1)], "run_name string, user_id long, item_id long, rank long")
    tsv.write_ranked_predictions(again, d)
    got = {(r["run_name"], r["item_id"]) for r in tsv.read_predictions(spark, os.path.join(d, "run_name=*")).collect()}
    # No appended duplicates for r1, r2 untouched
    assert got == {("r1", 7), ("r2", 5)}


def test_tokenized_prompt_features(spark):
    from shelfwise.operators.truncate import ByteTokenizer, tokenize_prompts

    df = spark.createDataFrame(
        [("r", 1, 2, "é ok", "Yes"), ("r", 3, 4, "", None)],
        "run_name string, user_id long, item_id long, prompt string, label_word string",
    )
    rows = {r["user_id"]: r for r in tokenize_prompts(df).collect()}
    tok = ByteTokenizer()
    assert rows[1]["input_ids"] == tok.encode("é ok") + [1]
    assert rows[1]["labels"] == tok.encode("Yes") + [1]
    assert tok.decode(rows[1]["input_ids"][:-1]) == "é ok"
    assert rows[3]["input_ids"] == [1] and rows[3]["labels"] is None
