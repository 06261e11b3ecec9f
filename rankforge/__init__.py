"""rankforge: ranking-sample, feature, scoring and evaluation jobs on Spark.

Every public function takes DataFrames (and a feature spec) and returns a
DataFrame plan; nothing is collected on the driver except small, size-bounded
summaries (fitted boundaries, gate weights of a dense head).

The most used entry points are re-exported here; importing them is cheap
(no session is created).
"""

__version__ = "0.1.0"

__all__ = [
    "FeatureSpec", "parse_ini", "load_ini", "to_ini",
    "compile_features", "fit_all_features", "fit_boundaries", "norm_stats",
    "score_lr", "score_fm", "sparse_inputs", "spec_embeddings", "spec_input_layer",
    "auc_exact", "auc_200", "eval_report", "weighted_logloss",
    "trailing_ctr", "cap_per_key", "first_per_key", "negative_sampling",
    "grad_step_lr", "train_deep", "build_session",
]


def __getattr__(name):
    # lazy re-exports: keep `import rankforge` free of pyspark start-up cost
    table = {
        "FeatureSpec": "rankforge.spec", "parse_ini": "rankforge.spec", "load_ini": "rankforge.spec",
        "to_ini": "rankforge.spec",
        "compile_features": "rankforge.functions.features",
        "fit_all_features": "rankforge.operators.fit", "fit_boundaries": "rankforge.operators.fit",
        "norm_stats": "rankforge.operators.fit",
        "score_lr": "rankforge.operators.scoring", "score_fm": "rankforge.operators.scoring",
        "sparse_inputs": "rankforge.operators.models", "spec_embeddings": "rankforge.operators.models",
        "spec_input_layer": "rankforge.operators.models",
        "auc_exact": "rankforge.operators.metrics", "auc_200": "rankforge.operators.metrics",
        "eval_report": "rankforge.operators.metrics", "weighted_logloss": "rankforge.operators.metrics",
        "trailing_ctr": "rankforge.operators.samples", "cap_per_key": "rankforge.operators.samples",
        "first_per_key": "rankforge.operators.samples", "negative_sampling": "rankforge.operators.samples",
        "grad_step_lr": "rankforge.operators.training", "train_deep": "rankforge.operators.training",
        "build_session": "rankforge.session",
    }
    if name in table:
        import importlib
        return getattr(importlib.import_module(table[name]), name)
    raise AttributeError(name)
