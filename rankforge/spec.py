"""Declarative feature specification.

A spec is an ordered list of ``Feature`` entries, one per INI section (the
reference's format: ``[name]`` then ``key = value`` lines). Every feature
compiles to one Column expression (``rankforge.functions.features``) or, for
embeddings, to a lookup join (``rankforge.operators.lookup``).
"""

from __future__ import annotations

import configparser
import warnings
from dataclasses import dataclass, field, replace

# The feature kinds and section keys the spec format accepts.
FTYPES = ("numeric", "bucketized", "cat_hash", "cat_hash_self", "cat_vocab", "cat_id",
          "cross", "indicator", "embedding", "shared_embedding")
KNOWN_KEYS = ("ftype", "fname", "shape", "dtype", "default", "boundaries", "auto_boundaries",
              "vocab", "num_buckets", "keys", "cat_col", "dimension", "combiner", "group",
              "is_out", "ckpt_to_load_from", "tensor_name_in_ckpt", "min", "max", "mean", "std")
CATEGORICAL = ("bucketized", "cat_hash", "cat_hash_self", "cat_vocab", "cat_id", "cross")


class SpecError(ValueError):
    pass


@dataclass(frozen=True)
class Feature:
    name: str
    ftype: str
    fname: str | None = None
    shape: int = 1
    dtype: str = "float"
    default: object = None
    boundaries: tuple = ()
    auto_boundaries: int = 0
    vocab: tuple = ()
    num_buckets: int = 0
    keys: tuple = ()
    cat_col: tuple = ()
    dimension: int = 0
    combiner: str = "sum"
    group: tuple = ()
    is_out: int = 1
    ckpt_to_load_from: str | None = None
    tensor_name_in_ckpt: str | None = None
    stats: tuple = ()  # ((stat, value), ...) from a fitting pass: min, max, mean, std

    @property
    def source(self) -> str:
        """Raw input column (``fname`` defaults to the section name)."""
        return self.fname or self.name

    @property
    def is_list(self) -> bool:
        """Multi-valued: a fixed vector (shape > 1) or a var-length list (shape 0)."""
        return self.shape != 1

    def n_ids(self) -> int:
        """Size of the id space this categorical feature produces."""
        if self.ftype == "bucketized":
            return (len(self.boundaries) + 1) * max(self.shape, 1)
        if self.ftype == "cat_vocab":
            return len(self.vocab)
        return self.num_buckets

    def stat(self, name: str, default=None):
        return dict(self.stats).get(name, default)


@dataclass
class FeatureSpec:
    features: list = field(default_factory=list)

    def __post_init__(self):
        self.validate()

    def __iter__(self):
        return iter(self.features)

    def __getitem__(self, name: str) -> Feature:
        for f in self.features:
            if f.name == name:
                return f
        raise KeyError(name)

    def names(self) -> list:
        return [f.name for f in self.features]

    def role(self, group: str, emitted_only: bool = True) -> list:
        """Features in a model-input role, honouring ``is_out``."""
        return [f for f in self.features
                if group in f.group and (f.is_out or not emitted_only)]

    def categorical(self) -> list:
        return [f for f in self.features if f.ftype in CATEGORICAL]

    def field_index(self) -> dict:
        """Stable integer id per feature (spec order), used to key weight tables."""
        return {f.name: i for i, f in enumerate(self.features)}

    def drop(self, names) -> "FeatureSpec":
        names = set(names)
        return FeatureSpec([f for f in self.features if f.name not in names])

    def with_fitted(self, boundaries: dict | None = None, stats: dict | None = None) -> "FeatureSpec":
        out = []
        for f in self.features:
            if boundaries and f.name in boundaries:
                f = replace(f, boundaries=tuple(float(b) for b in boundaries[f.name]))
            if stats and f.name in stats:
                f = replace(f, stats=tuple(sorted(stats[f.name].items())))
            out.append(f)
        return FeatureSpec(out)

    def validate(self) -> None:
        seen = set()
        for f in self.features:
            if f.name in seen:
                raise SpecError(f"duplicate feature section [{f.name}]")
            seen.add(f.name)
            if f.ftype not in FTYPES:
                raise SpecError(f"[{f.name}] unknown ftype {f.ftype!r}")
            if f.ftype in ("cat_hash", "cat_hash_self", "cat_id", "cross") and f.num_buckets <= 0:
                raise SpecError(f"[{f.name}] {f.ftype} needs num_buckets > 0")
            if f.ftype == "cat_vocab" and not f.vocab:
                raise SpecError(f"[{f.name}] cat_vocab needs a vocab")
            if f.ftype in ("embedding", "shared_embedding") and f.dimension <= 0:
                raise SpecError(f"[{f.name}] {f.ftype} needs dimension > 0")
            if f.combiner not in ("sum", "mean", "sqrtn"):
                raise SpecError(f"[{f.name}] unknown combiner {f.combiner!r}")
        for f in self.features:
            for ref in f.keys + f.cat_col:
                if ref not in seen and f.ftype != "cross":
                    raise SpecError(f"[{f.name}] refers to missing feature {ref!r}")
            if f.ftype == "cross" and len(f.keys) < 2:
                raise SpecError(f"[{f.name}] cross needs at least two keys")


def _split(v: str) -> tuple:
    return tuple(x.strip() for x in v.split(",") if x.strip() != "")


def _typed_default(ftype: str, dtype: str, raw):
    if raw is None:
        return None
    if dtype == "string":
        return raw
    if dtype == "int64":
        return int(float(raw))
    return float(raw)


def parse_ini(text: str, strict: bool = True) -> FeatureSpec:
    """Read an INI feature spec. Unknown keys (e.g. misspelt ``defaut``) raise
    in strict mode and warn otherwise; duplicate sections always raise."""
    cp = configparser.ConfigParser(strict=True, interpolation=None, inline_comment_prefixes=None)
    try:
        cp.read_string(text)
    except (configparser.DuplicateSectionError, configparser.DuplicateOptionError) as e:
        raise SpecError(str(e)) from e
    feats = []
    for sec in cp.sections():
        d = dict(cp[sec])
        unknown = sorted(set(d) - set(KNOWN_KEYS))
        if unknown:
            msg = f"[{sec}] unknown keys {unknown}"
            if strict:
                raise SpecError(msg)
            warnings.warn(msg)
        ftype = d.get("ftype", "numeric")
        dtype = d.get("dtype", "string" if ftype in ("cat_hash",) else "float")
        stats = tuple((k, float(d[k])) for k in ("max", "mean", "min", "std") if k in d)
        feats.append(Feature(
            name=sec, ftype=ftype, fname=d.get("fname"),
            shape=int(d.get("shape", 1)), dtype=dtype,
            default=_typed_default(ftype, dtype, d.get("default")),
            boundaries=tuple(float(x) for x in _split(d.get("boundaries", ""))),
            auto_boundaries=int(d.get("auto_boundaries", 0)),
            vocab=_split(d.get("vocab", "")),
            num_buckets=int(d.get("num_buckets", 0)),
            keys=_split(d.get("keys", "")), cat_col=_split(d.get("cat_col", "")),
            dimension=int(d.get("dimension", 0)), combiner=d.get("combiner", "sum"),
            group=_split(d.get("group", "")), is_out=int(d.get("is_out", 1)),
            ckpt_to_load_from=d.get("ckpt_to_load_from"),
            tensor_name_in_ckpt=d.get("tensor_name_in_ckpt"), stats=stats))
    return FeatureSpec(feats)


def load_ini(path: str, strict: bool = True) -> FeatureSpec:
    with open(path, encoding="utf-8") as fh:
        return parse_ini(fh.read(), strict=strict)


def to_ini(spec: FeatureSpec) -> str:
    """Write a spec back as INI (the fitted-spec sink in text form)."""
    lines = []
    for f in spec:
        lines.append(f"[{f.name}]")
        lines.append(f"ftype = {f.ftype}")
        if f.fname:
            lines.append(f"fname = {f.fname}")
        if f.shape != 1:
            lines.append(f"shape = {f.shape}")
        if f.dtype != "float":
            lines.append(f"dtype = {f.dtype}")
        if f.default is not None:
            lines.append(f"default = {f.default}")
        if f.boundaries:
            lines.append("boundaries = " + ",".join(repr(float(b)) for b in f.boundaries))
        if f.auto_boundaries:
            lines.append(f"auto_boundaries = {f.auto_boundaries}")
        for k in ("vocab", "keys", "cat_col", "group"):
            v = getattr(f, k)
            if v:
                lines.append(f"{k} = " + ",".join(str(x) for x in v))
        if f.num_buckets:
            lines.append(f"num_buckets = {f.num_buckets}")
        if f.dimension:
            lines.append(f"dimension = {f.dimension}")
            lines.append(f"combiner = {f.combiner}")
        if not f.is_out:
            lines.append("is_out = 0")
        for k, v in f.stats:
            lines.append(f"{k} = {v!r}")
        lines.append("")
    return "\n".join(lines)
