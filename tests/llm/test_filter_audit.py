"""The filter audit against a plain version that applies the filters one after another."""

import re
from itertools import permutations

from pyspark.sql import functions as F

from tests.llm.tables import awkward, empty, prose
from tillhouse.llm import filter_audit


def failures(rows):
    """Per row the set of filters that it fails, from (id, text)."""
    least = {}
    for key, text in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = []
    for key, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        if len(words) < 100:
            failed.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text):
            failed.add("C")
        if re.search(r"[#$%&*|]", text):
            failed.add("D")
        if key is not None and least[text] < key:
            failed.add("E")
        out.append(failed)
    return out


def plain_audit(rows, labels):
    """{(part, order, step): figures} of (id, text, part) rows and (id, quality, toxic) labels."""
    good, toxic = {k for k, q, _ in labels if q == 1} - {None}, {k for k, _, t in labels if t == 1} - {None}
    failed = failures([row[:2] for row in rows])
    out = {}
    for part in {row[2] or "" for row in rows}:
        own = [(row[0], bad) for row, bad in zip(rows, failed) if (row[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone, left_over = [x for x in left if name in x[1]], [x for x in left if name not in x[1]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    name,
                    len(left_over),
                    len(gone),
                    sum(name in bad for _, bad in own) - len(gone),
                    sum(bad == {name} for _, bad in own),
                    sum(key in good for key, _ in gone),
                    sum(key in toxic for key, _ in gone),
                ]
                left = left_over
        for (p, _, _), figures in out.items():
            if p == part:
                figures.append(shapley[figures[0]])
    return out


def figures(frame):
    names = "filter kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in frame.collect()}


LABELS = [(3, 1, 0), (3, 0, 1), (12, 1, 0), (14, 0, 1), (None, 1, 1), (5, None, None), (999, 1, 1)]


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("l"), F.col("doc_id") % 3)))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    assert figures(filter_audit.audit_filters(docs, labels(spark))) == plain_audit(rows, LABELS)


def test_a_text_held_by_most_rows(spark):
    hot, other = prose(5, 120), "AB CD & ef"
    rows = [(k, hot if k % 3 else f"{other} {k % 7}", "en" if k % 5 else "de") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    assert figures(filter_audit.audit_filters(docs, labels(spark))) == plain_audit(rows, LABELS)
    copies = filter_audit.later_copies(docs)
    expected = {key for (key, _, _), bad in zip(rows, failures([row[:2] for row in rows])) if "E" in bad}
    assert {row["doc_id"] for row in copies.collect()} == expected and copies.columns == docs.columns


def test_tables_without_rows(spark):
    nothing = empty(spark).withColumn("lang", F.lit("en"))
    assert filter_audit.audit_filters(nothing, labels(spark)).count() == 0
    some = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert filter_audit.audit_filters(some, labels(spark).limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_no_join_without_keys_and_no_text_of_single_rows_shuffled(spark):
    docs = awkward(spark)
    plan = filter_audit.later_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
