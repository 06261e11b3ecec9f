import pytest

from rankforge.spec import SpecError, parse_ini, to_ini

GOOD = """
[age]
ftype = numeric
default = 0.0
group = dnn,norm

[age_cat]
ftype = bucketized
fname = age
boundaries = 18.0,25.0,35.0
auto_boundaries = 10
group = linear

[sex_cat]
ftype = cat_vocab
fname = sex
dtype = int64
vocab = 0,1,2
is_out = 0

[x]
ftype = cross
keys = age_cat,sex_cat
num_buckets = 20
group = linear

[sex_emb]
ftype = embedding
cat_col = sex_cat
dimension = 4
group = dnn
"""


def test_parse_roles_and_defaults():
    spec = parse_ini(GOOD)
    assert spec.names() == ["age", "age_cat", "sex_cat", "x", "sex_emb"]
    assert spec["age_cat"].source == "age"
    assert spec["age"].source == "age"          # fname defaults to the section name
    assert spec["age_cat"].n_ids() == 4          # n boundaries → n+1 buckets
    assert [f.name for f in spec.role("linear")] == ["age_cat", "x"]
    assert [f.name for f in spec.role("dnn")] == ["age", "sex_emb"]
    assert spec["sex_cat"].is_out == 0


def test_unknown_key_rejected_or_warned():
    bad = "[a]\nftype = numeric\ndefaut = 1.0\n"
    with pytest.raises(SpecError):
        parse_ini(bad)
    with pytest.warns(UserWarning):
        parse_ini(bad, strict=False)


def test_duplicate_and_dangling():
    with pytest.raises(SpecError):
        parse_ini("[a]\nftype = numeric\n[a]\nftype = numeric\n")
    with pytest.raises(SpecError):
        parse_ini("[e]\nftype = embedding\ncat_col = missing\ndimension = 2\n")
    with pytest.raises(SpecError):
        parse_ini("[h]\nftype = cat_hash\n")


def test_roundtrip():
    spec = parse_ini(GOOD)
    again = parse_ini(to_ini(spec))
    assert again.names() == spec.names()
    assert again["age_cat"].boundaries == spec["age_cat"].boundaries
