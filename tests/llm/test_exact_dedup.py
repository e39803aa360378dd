import random
import re
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from feedmart.llm import exact_dedup, queries
from feedmart.llm.common import table


def _brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", r.text or "")].append(r)
    out = []
    for body, rs in groups.items():
        best = min(rs, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        out += [(r.doc_id, best.doc_id, len(rs), sha256(body.encode()).hexdigest()) for r in rs]
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    got = queries.op8_exact_dedup(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == _brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_edges(edge_docs):
    got = exact_dedup.exact_groups(edge_docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == _brute(edge_docs.collect())
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})  # one row of each group, also of repeated rows


def test_drop_copies_keeps_columns_and_one_row(edge_docs):
    out = exact_dedup.drop_copies(edge_docs)
    assert out.columns == edge_docs.columns
    texts = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in out.collect()]
    assert len(texts) == len(set(texts)) == exact_dedup.exact_groups(edge_docs).select("text_sha256").distinct().count()


def test_empty_table(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_identifiers_that_collide_are_seen(spark):
    rows = exact_dedup.recipes(spark.createDataFrame([(1, "a" * 3000), (2, "b" * 3000)], "doc_id long, text string"))
    assert exact_dedup.verified(rows)
    forged = rows.withColumn("recipe", F.transform("recipe", lambda c: c.withField("id", F.lit(7))))
    assert not exact_dedup.verified(forged)


def test_long_text_has_many_chunks_and_an_edit_changes_few(spark):
    text = " ".join(f"w{i * 7919 % 104729}{"adf" if i % 5 == 0 else "mnn"}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, text[:60_000] + "EDIT" + text[60_000:])], "doc_id long, text string")
    a, b = (set(c.id for c in r.recipe) for r in exact_dedup.recipes(docs).orderBy("doc_id").collect())
    assert len(a) > 50 and len(a - b) < 10


def test_chunks_of_every_script_follow_the_content(spark):
    """A letter put in front, and one in the middle, leave nearly all chunks as they are: Cyrillic, Greek, Arabic, Chinese, Korean, digits, capitals."""
    rng = random.Random(1)
    letters = {"cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "arabic": "".join(map(chr, range(0x621, 0x64B))),
               "chinese": "".join(chr(0x4E00 + rng.randrange(20_000)) for _ in range(3000)), "korean": "".join(chr(0xAC00 + rng.randrange(11_000)) for _ in range(2000)),
               "digits": "0123456789", "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "latin": "abcdefghijklmnopqrstuvwxyz"}
    rows = []
    for name, a in letters.items():
        text = "".join(rng.choices(a, k=40_000))
        rows += [(f"{name} whole", text), (f"{name} edited", a[0] + text[:20_000] + a[1] + text[20_000:])]
    found = {r.doc_id: [c.id for c in r.recipe] for r in exact_dedup.recipes(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    for name in letters:
        whole, edited = found[f"{name} whole"], found[f"{name} edited"]
        assert len(whole) > 40_000 / 700, (name, len(whole))
        assert len(set(whole) & set(edited)) >= 0.9 * len(whole), name
