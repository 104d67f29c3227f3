"""Totals from changes against a full recompute of the records."""

import random

from pyspark.sql import functions as F

from pagetally.operators import summaries
from pagetally.plans.changes import ReportTotals, changes

SCHEMA = "slug string, pay bigint, jobs bigint, education string, exposure double"


def record(rng, slug):
    return (slug, rng.choice([None, 0, 34999, 35000, 62000, 250000]),
            rng.choice([None, 0, 1, 17, 10 ** 9]),
            rng.choice([None, "Bachelor's degree", "Master's degree", "none"]),
            rng.choice([None, 0.0, 1.0, 1.5, 7.1, 10.0, 0.1]))


def rows(frame):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in row)
            for row in sorted(frame.collect(), key=lambda r: str(r[0]))]


def same(totals, records):
    assert rows(totals.headline()) == rows(summaries.headline(records))
    for name in ("tier_summary", "band_means", "group_means"):
        assert rows(getattr(totals, name)()) == rows(getattr(summaries, name)(records)), name


def test_random_changes(spark, tmp_path):
    rng = random.Random(6)
    totals, held = ReportTotals(spark, str(tmp_path / "t")), {}

    def frame(records):
        return spark.createDataFrame(list(records), SCHEMA)
    for batch in range(4):
        new = {f"{batch}-{i}": record(rng, f"{batch}-{i}") for i in range(40)}
        gone = rng.sample(sorted(held), min(len(held), 10))
        moved = rng.sample(sorted(set(held) - set(gone)), min(len(held) - len(gone), 15))
        after = {slug: record(rng, slug) for slug in moved}
        change = changes(frame(new.values()), frame(held[s] for s in gone),
                         (frame(held[s] for s in moved), frame(after.values())))
        totals.apply(f"b{batch}", change)
        if batch == 2:
            totals.apply("b2", change)      # a batch that comes again counts once
            totals.compact()
        held = {**{s: r for s, r in held.items() if s not in gone}, **after, **new}
        if batch in (0, 3):
            same(totals, frame(held.values()))


def test_everything_taken_away_leaves_nothing(spark, tmp_path):
    """Fractions cancel exactly, whatever the order."""
    rng = random.Random(7)
    records = spark.createDataFrame([record(rng, str(i)) for i in range(200)], SCHEMA)
    totals = ReportTotals(spark, str(tmp_path / "t"))
    assert totals.headline().first()[:3] == (0, 0, 0)
    totals.apply("in", changes(inserted=records))
    totals.apply("out", changes(deleted=records.orderBy(F.rand(1))))
    assert tuple(totals.headline().first()) == (0, 0, 0, 0.0)
    assert totals.band_means().collect() == [] == totals.group_means().collect()
    assert {r.n for r in totals.tier_summary().collect()} == {0}
