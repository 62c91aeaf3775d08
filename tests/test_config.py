"""Options: coercion, suggestions, ranges, precedence, blocks; and a whole run on a small cohort."""

from __future__ import annotations

import pytest
import yaml

from clustrata.plans import config
from clustrata.plans.branch import BranchSettings


def load(tmp_path, held: dict, *argv: str):
    (tmp_path / "m.csv").write_text("gene,s1,s2\nA,1,2\n")
    path = tmp_path / "c.yaml"
    path.write_text(yaml.safe_dump({"counts": str(tmp_path / "m.csv"), **held}))
    return config.load(["--config", str(path), *argv])


OPTIONS = config.OPTIONS.values()


def outside(option: config.Option) -> list:
    """Values just beyond what an option's declaration allows."""
    step = 1 if option.kind == "int" else 0.25
    out = ["three", *([0.5] if option.kind == "int" else [])] if option.kind in ("int", "float") else []
    if option.kind in ("int", "float") and option.low is not None:
        out.append(option.low if option.open_low else option.low - step)
    if option.kind in ("int", "float") and option.high is not None:
        out.append(option.high if option.open_high else option.high + step)
    return out


@pytest.mark.parametrize("option", [o for o in OPTIONS if o.choices], ids=lambda o: o.name)
def test_every_choice_is_checked(tmp_path, option):
    """A choice without its last letter names the option and what it may be; each choice itself is no such problem."""
    wrong = option.choices[0][:-1] + "~"
    with pytest.raises(config.ConfigError) as error:
        load(tmp_path, {option.name: wrong})
    assert any(p.startswith(f"{option.name}: ") and option.choices[0] in p for p in error.value.problems)
    for choice in option.choices:
        problems: list[str] = []
        assert config.coerce(option, choice, problems) == choice and not problems


@pytest.mark.parametrize(("option", "value"), [(o, v) for o in OPTIONS for v in outside(o)], ids=lambda x: getattr(x, "name", str(x)))
def test_every_bound_is_checked(tmp_path, option, value):
    with pytest.raises(config.ConfigError, match=option.name):
        load(tmp_path, {option.name: value})


@pytest.mark.parametrize("option", [o for o in OPTIONS if o.kind in ("flag", "switch")], ids=lambda o: o.name)
def test_every_switch_is_checked(tmp_path, option):
    with pytest.raises(config.ConfigError, match=f"{option.name}: 'sometimes' is not y or n"):
        load(tmp_path, {option.name: "sometimes"})


def test_misspelt_names(tmp_path):
    """A name with its last letter doubled points to the right one, if it is long enough to tell."""
    for option in OPTIONS:
        if len(option.name) >= 8:
            with pytest.raises(config.ConfigError, match=option.name):
                load(tmp_path, {option.name + option.name[-1]: option.default})


def test_settings_that_contradict_each_other(tmp_path):
    least, most = config.OPTIONS["k_min"].default, config.OPTIONS["k_max"].default
    for held, word in (
        ({"k_min": most + 1}, "k_min"),
        ({"k_final": most + 2}, "k_final"),
        ({"k_final": least - 1}, "k_final"),
        ({"ica_n_components_min": 21, "ica_n_components_max": 20}, "ica_n_components_min"),
        ({"already_normalized": True, "run_degsea": "y"}, "already_normalized"),
        ({"n_jobs": 0}, "n_jobs"),
        ({"purity_threshold": "two"}, "purity_threshold"),
        ({"clinical_degsea": {"trial": {"design": "~ site + arm"}}}, "lacks"),
    ):
        with pytest.raises(config.ConfigError, match=word):
            load(tmp_path, held)


def test_all_problems_at_once(tmp_path):
    with pytest.raises(config.ConfigError) as error:
        load(tmp_path, {"base": "x", "k_min": 9, "n_jobs": 0, "counts": "/none.csv"})
    assert len(error.value.problems) >= 4


def test_precedence(tmp_path):
    options, _ = load(tmp_path, {"k_max": 7, "seed": 3}, "--k-max", "8")
    assert (options["k_max"], options["seed"], options["k_min"]) == (8, 3, 3)


def test_booleans_and_unknown_keys(tmp_path):
    options, warnings = load(tmp_path, {"run_ica": False, "scale_genes": "yes", "zzzzzz": 1})
    assert options["run_ica"] == "n" and options["scale_genes"] is True and any("zzzzzz" in w for w in warnings)


def test_blocks(tmp_path):
    options, _ = load(tmp_path, {
        "ordinal_variables": {"grade": [1, 2, 3]},
        "signature_sources": {"a": "x.gmt", "b": {"path": "y.csv", "sep": ","}},
        "clinical_degsea": {"my exp": {"design": "~ arm", "contrast": ["arm", "b", "a"]}},
        "gsea_collections": {"h": "h.gmt"},
        "deconv_methods": {"one": "y", "two": "n", "three": {"enabled": "y", "q": 1}},
    })
    assert options["ordinal_variables"] == {"grade": ["1", "2", "3"]}
    assert options["signature_sources"]["a"] == {"path": "x.gmt"}
    assert options["clinical_degsea"][0] == {"name": "my_exp", "design": "~ arm", "variable": "arm", "test": "b", "control": "a"}
    assert config.collections(options) == {"h": "h.gmt"}
    assert config.enabled(options["deconv_methods"]) == {"one": {}, "three": {"q": 1}}


def test_other_forms_of_blocks(tmp_path, monkeypatch):
    monkeypatch.setenv("HOME", "/home/me")
    options, warnings = load(tmp_path, {
        "gsea_collections": {"h": {"enabled": "y", "path": "~/h.gmt"}, "off": {"enabled": False, "path": "o.gmt"}, "none": {"enabled": "y"}},
        "load_kegg": "k.gmt",
        "ordinal_variables": ["grade"],
        "clinical_degsea": {"enabled": True, "experiments": {
            "a": {"design": "~ arm", "contrast": "arm", "test": "b", "control": "a", "collections": ["kegg"], "min_group": 5},
            "b": {"design": "~ arm", "contraste": "arm", "test": "b", "control": "a"},
            "c": {"enabled": "n"},
        }},
        "ica_algorithm": "picard",
    })
    assert config.collections(options) == {"h": "/home/me/h.gmt", "kegg": "k.gmt"}
    assert options["ordinal_variables"] == {"grade": None}
    one, two = options["clinical_degsea"]
    assert (one["variable"], one["min_group"], two["variable"]) == ("arm", 5, "arm")
    assert config.experiment_collections(options, one) == {"kegg": "k.gmt"}
    assert config.experiment_collections(options, two) == config.collections(options)
    assert config.experiment_collections(options, two | {"collections": "~/own.gmt"}) == {"own": "/home/me/own.gmt"}
    assert any("ica_algorithm" in w for w in warnings) and not any("n_jobs" in w for w in warnings)
    with pytest.raises(config.ConfigError, match="reactome"):
        load(tmp_path, {"clinical_degsea": {"a": {"design": "~ x", "contrast": "x", "test": 1, "control": 2, "collections": ["reactome"]}}})
    assert load(tmp_path, {"clinical_degsea": {"enabled": "n", "a": {}}})[0]["clinical_degsea"] == []


def test_log_file(tmp_path):
    import logging

    from clustrata.plans import pipeline

    handler = pipeline.log_file(str(tmp_path / "deep"), "run.log")
    handler.emit(logging.LogRecord("x", logging.INFO, "", 0, "hello", None, None))
    handler.close()
    assert (tmp_path / "deep/run.log").read_text().endswith("INFO x hello\n")
    assert pipeline.log_file("s3://bucket/out", "run.log") is None


def test_missing_file():
    with pytest.raises(config.ConfigError, match="exist"):
        config.load(["--config", "/none.yaml"])
    with pytest.raises(config.ConfigError, match="counts"):
        config.load([])


def test_settings():
    s = BranchSettings.of({"k_min": 2, "tsne_dim": "3", "compute_jaccard": "n", "run_chi2": "y", "k_final": None})
    assert (s.k_min, s.tsne_dim, s.compute_jaccard, s.run_chi2, s.k_final) == (2, 3, False, True, None)


def test_tables_from_scores_and_fractions(spark, tmp_path):
    from types import SimpleNamespace

    from clustrata.plans.pipeline import Pipeline
    from clustrata.sources import tables

    names = [f"s{i:02d}" for i in range(12)]
    counts = spark.createDataFrame([(s, f"g{g:02d}", float((i * 7 + g * 5) % 11 + g)) for i, s in enumerate(names) for g in range(20)], "sample string, gene string, value double")
    meta = spark.createDataFrame([(s, float(i), "ab"[i % 2]) for i, s in enumerate(names)], "sample string, age double, arm string")
    (tmp_path / "sets.gmt").write_text("A\tna\t" + "\t".join(f"g{g:02d}" for g in range(8)) + "\nB\tna\t" + "\t".join(f"g{g:02d}" for g in range(8, 15)) + "\n")
    (tmp_path / "cells.csv").write_text("method,cell_type,sample,fraction\n" + "".join(f"m,T,{s},{i}\n" for i, s in enumerate(names)))
    options, _ = load(tmp_path, {"outdir": str(tmp_path / "out"), "compute_signatures": "y", "signatures_gmt": str(tmp_path / "sets.gmt"), "run_deconv": "y", "deconv_table": str(tmp_path / "cells.csv"), "deconv_methods": {"mean": {"markers": str(tmp_path / "sets.gmt")}, "other": "y"}, "ordinal_variables": ["arm"]})
    run = Pipeline(spark, options)
    run.raw, run.matrix, run.metadata, run.scores = counts, counts, meta, {}
    partition = meta.selectExpr("3 as k", "sample", "cast(age as int) % 3 + 1 as cluster")
    run.branch = SimpleNamespace(tables={"partition": partition}, k=3)
    assert run._ordinal() == {"arm": ["a", "b"]}
    run._signatures()
    run._correlations(run._deconvolution(None))
    assert {"signature_associations", "top_signatures", "signature_boxes", "deconvolution_fractions", "features", "feature_correlations", "feature_clinic_matrix"} <= set(run.results)
    features = {r[0] for r in run.results["features"].select("feature").distinct().collect()}
    assert features == {"clinic:age", "mean:A", "mean:B", "ssgsea:A", "ssgsea:B", "deconv:m:T", "deconv:mean:A", "deconv:mean:B"}
    same = run.results["feature_correlations"].where("f1 = 'clinic:age' and f2 = 'deconv:m:T'").first()
    assert abs(same["r"] - 1) < 1e-9
    assert run.results["signature_boxes"].count() == 6
    assert tables.read_table(spark, str(tmp_path / "cells.csv")).columns == ["method", "cell_type", "sample", "fraction"]


def test_whole_run(spark, tmp_path):
    from clustrata.plans.pipeline import Pipeline
    from clustrata.sources import tables

    counts, meta = tables.simulate_cohort(spark, 40, 150)
    wide = counts.toPandas().pivot(index="gene", columns="sample", values="value")
    wide.to_csv(tmp_path / "counts.csv")
    meta.toPandas().to_csv(tmp_path / "meta.csv", index=False)
    (tmp_path / "sets.gmt").write_text("A\tna\t" + "\t".join(wide.index[10:40]) + "\nB\tna\t" + "\t".join(wide.index[60:100]) + "\n")
    options, _ = config.load([
        "--counts", str(tmp_path / "counts.csv"), "--metadata", str(tmp_path / "meta.csv"), "--outdir", str(tmp_path / "out"), "--color-by", "true_subtype",
        "--norm-method", "logcpm", "--n-resamples", "8", "--k-min", "3", "--k-max", "3", "--run-ica", "n", "--compute-signatures", "y", "--signatures-gmt", str(tmp_path / "sets.gmt"),
        "--no-umap", "--min-cluster-size", "3", "--chi2-mc-resamples", "10", "--run-correlations", "n",
    ])
    done = Pipeline(spark, options).run()
    assert done.branch.k == 3 and (tmp_path / "out/report.html").exists() and (tmp_path / "out/run_params.json").exists()
    assert {"k_selection", "assignments", "branch_stability", "embeddings", "associations", "scores_mean_z", "signature_group_tests", "crosstab_true_subtype"} <= set(done.results)
    assert done.results["assignments"].where(f"k = {done.branch.k}").count() == 40
