import math

import pytest

from rankforge.operators.models import spec_embeddings, spec_input_layer
from rankforge.spec import parse_ini

SPEC = parse_ini("""
[age]
ftype = numeric
group = user
[sex_cat]
ftype = cat_vocab
fname = sex
vocab = f,m
is_out = 0
[z_sex_cat]
ftype = cat_vocab
fname = z_sex
vocab = f,m
is_out = 0
[songs_cat]
ftype = cat_id
fname = songs
shape = 0
num_buckets = 10
is_out = 0
[sex_emb]
ftype = shared_embedding
cat_col = sex_cat,z_sex_cat
dimension = 2
group = user
[songs_emb]
ftype = embedding
cat_col = songs_cat
dimension = 3
combiner = mean
group = user
""")


def w(f, b, d):
    return ((f * 7919 + b * 104729 + d * 1299709) % 2001 - 1000) / 10000.0


def test_shared_list_and_width(spark):
    df = spark.createDataFrame([("a", 30.0, "m", "f", [1, 3, 3]), ("b", 20.0, "x", "m", [])],
                               "sample_id string, age double, sex string, z_sex string, songs array<bigint>")
    out = spec_embeddings(df, SPEC)
    rows = {r.sample_id: r for r in out.collect()}
    fs, fl = SPEC.field_index()["sex_emb"], SPEC.field_index()["songs_emb"]
    # shared: both inputs read the section's table; emitted as their concatenation
    assert rows["a"].sex_emb == pytest.approx([w(fs, 1, 0), w(fs, 1, 1), w(fs, 0, 0), w(fs, 0, 1)])
    assert rows["b"].sex_emb == pytest.approx([0.0, 0.0, w(fs, 1, 0), w(fs, 1, 1)])   # unknown vocab → zeros
    # list input, mean combiner; duplicates count twice; empty list → zero vector
    exp = [(w(fl, 1, d) + 2 * w(fl, 3, d)) / 3 for d in range(3)]
    assert rows["a"].songs_emb == pytest.approx(exp)
    assert rows["b"].songs_emb == [0.0, 0.0, 0.0]
    assert "sex_cat" not in out.columns               # helper inputs (is_out = 0) not emitted
    lay, width = spec_input_layer(out, SPEC, "user")
    assert width == 1 + 4 + 3
    assert all(len(r.input) == width for r in lay.collect())
