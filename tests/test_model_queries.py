"""The model queries search the whole grids of the library, and small ones really end."""

import math

from checks import model_queries
from citypulse.ml import model, search


def test_whole_grids():
    grids = {name: family.grid for name, (_, family) in model_queries.SEARCHES.items()}
    assert grids == {"boosted": model.BOOSTED_GRID, "boosted_on_scores": model.QUANTILE_BOOSTED_GRID, "forest": search.FOREST_SETTINGS}
    assert {name: len(family.settings) for name, (_, family) in model_queries.SEARCHES.items()} == {"boosted": 36, "boosted_on_scores": 24, "forest": 18}
    assert math.prod(map(len, model.FOREST_GRID.values())) == 18


def test_queries_on_small_grids(spark, monkeypatch):
    """The four queries from end to end, with every grid cut to two settings."""
    small = {
        name: (features, search.Family(family.kind, {k: v[:1] for k, v in family.grid.items()} | {next(iter(family.grid)): [2, 3]}))
        for name, (features, family) in model_queries.SEARCHES.items()
    }
    monkeypatch.setattr(model_queries, "SEARCHES", small)
    sf_dir = "/root/testdata/sf0.001"
    compared = model_queries.forest_and_boosted_compared(spark, sf_dir).collect()
    assert [(r.name, r.settings_tried) for r in sorted(compared)] == [("boosted", 2), ("boosted_on_scores", 2), ("forest", 2)]
    assert all(r.rows_below_zero == 0 and r.scores_possible and r.errors_ordered and r.rows_scored == compared[0].rows_scored for r in compared)
    stacked = model_queries.stacked_predictions(spark, sf_dir)
    assert stacked.count() == compared[0].rows_scored and stacked.filter("not within_totals").count() == 0
    shares = model_queries.feature_importance(spark, sf_dir).collect()
    assert len(shares) == 5 and all(r.total_share == 1.0 and r.share_possible for r in shares)
