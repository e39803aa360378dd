import hashlib
import random

from feedmart.llm import fingerprints as fp
from feedmart.llm import queries
from feedmart.llm.common import table


def _slow_gear(data):
    out = []
    for i in range(len(data)):
        out.append(sum(int(fp._gear[data[i - j]]) << j for j in range(min(fp.WINDOW, i + 1))) & 0xFFFF)
    return out


def _brute(rows):
    rows = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        new = text[:len(text) - n] + following[:n]
        own = fp.chunk_weights(text)
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.fingerprint(own), fp.fingerprint(fp.chunk_weights(new)),
                    fp.containment(own, fp.chunk_weights(new)), fp.containment(own, fp.chunk_weights(following))))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    got = queries.op7_fingerprints(spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == _brute(table(spark, sf_dir, "documents").collect())
    long = [r for r in got if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.65 and sum(r.near_next for r in long) / len(long) < 0.05


def test_edges(spark, edge_docs, no_docs):
    assert sorted(map(tuple, fp.fingerprints(edge_docs).collect()), key=str) == _brute(edge_docs.collect())
    assert fp.fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert fp.fingerprints(one).head()[2] == hashlib.sha256(b"abca").hexdigest()


def test_gear_and_boundaries():
    data = "Ünïcode and plain text, mixed. ".encode() * 9
    assert fp.gear(data).tolist() == _slow_gear(data)
    ends = fp.boundaries(data)
    sizes = [b - a for a, b in zip([0] + ends, ends)]
    assert ends[-1] == len(data) and all(fp.LEAST <= s <= fp.MOST for s in sizes[:-1])
    assert fp.boundaries(b"") == []


def test_shift_resistance():
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000))
    own, shifted = fp.chunk_weights(text), fp.chunk_weights("inserted at the front " + text)
    assert fp.containment(own, shifted) > 0.98
    assert fp.containment(own, own) == 1.0
