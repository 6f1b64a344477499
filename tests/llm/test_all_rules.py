"""The rule ensemble hands every rule of the forest to the lasso."""
from llm import rule_ensemble


def test_no_rule_is_thrown_away():
    trees = [f"Tree\n  If (feature 1 <= {k}.5)\n    Predict: 1.0\n  Else (feature 1 > {k}.5)\n    Predict: 0.0\n" for k in range(200)]
    rules = rule_ensemble.distinct_rules([*trees, *trees])
    assert len(rules) == 400 and rules[-1] == ((1, ">", 199.5),)


def test_all_distinct_rules_are_fitted(spark, monkeypatch):
    given = []
    column = rule_ensemble.rule_column
    monkeypatch.setattr(rule_ensemble, "rule_column", lambda r, stats: given.append(r) or column(r, stats))
    forest = rule_ensemble.distinct_rules
    monkeypatch.setattr(rule_ensemble, "distinct_rules", lambda trees: given.append(len(forest(trees))) or forest(trees))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rule_ensemble.fit(rule_ensemble.training_rows(docs, labels))
    assert len(given) - 1 == given[0] > 0
