from __future__ import annotations

from datetime import date, datetime

import pytest

from rankmart.plans import views
from rankmart.plans.gold import player_progression, skills_progression

AT = datetime(2024, 3, 1, 12)


@pytest.fixture(scope="module")
def mart(spark):
    players = [
        (1, "Ana", "antica", "knight", 90, 900, "Open PvP"),
        (2, "Bo", "secura", "druid", 80, 800, "Optional PvP"),
        (3, "D'Ann", "antica", "druid", 70, 700, "Open PvP"),
        (4, "a.b", "antica", "monk", 60, 600, "Open PvP"),
    ]
    days = [date(2024, 2, 29), date(2024, 3, 1)]
    return spark.createDataFrame(
        [(*p, AT, day) for day in days for p in players] * 2,
        """rank bigint, name string, world string, vocation string, level int, experience bigint,
        world_type string, updated_at timestamp, snapshot_date date""",
    )


def names(df):
    return [r["name"] for r in df.collect()]


def test_read_is_distinct_and_ordered(mart):
    one = views.experience_rank_rows(mart, "2024-03-01T00:00:00")
    assert [r["rank"] for r in one.collect()] == [1, 2, 3, 4]
    both = views.experience_rank_rows(mart).collect()
    assert [(r["snapshot_date"].day, r["rank"]) for r in both] == [
        (d, r) for d in (1, 29) for r in (1, 2, 3, 4)
    ]


def test_top_n_is_on_the_global_rank(mart):
    day = views.experience_rank_rows(mart, "2024-03-01")
    assert names(views.ranking_view(day, top=2, world="Antica")) == ["Ana"]
    assert names(views.ranking_view(day, top=10, vocations=["Druid"])) == ["Bo", "D'Ann"]
    assert names(views.ranking_view(day, top=10, world_types=["optional pvp"])) == ["Bo"]
    assert names(views.ranking_view(day, top=10, world_types=[])) == []


def test_the_newest_snapshot_is_the_default(mart):
    view = views.ranking_view(views.experience_rank_rows(mart))
    assert {r["snapshot_date"] for r in view.collect()} == {date(2024, 3, 1)}


def test_search_is_literal_unless_asked(mart):
    day = views.experience_rank_rows(mart, "2024-03-01")
    assert names(views.ranking_view(day, text="AN")) == ["Ana", "D'Ann"]
    assert names(views.ranking_view(day, text="a.")) == ["a.b"]
    assert names(views.ranking_view(day, text="^A.", regex=True)) == ["Ana", "a.b"]


def test_kpis_and_display(mart):
    view = views.ranking_view(views.experience_rank_rows(mart), top=3)
    kpis = views.ranking_kpis(view).first().asDict()
    assert kpis == {
        "players": 3, "max_level": 90, "min_level": 70, "worlds": 2, "last_update": AT,
        "max_experience": 900,
    }
    first = views.ranking_display(view).first()
    assert (first["world"], first["world_type"]) == ("Antica", "Open Pvp")
    assert (first["experience"], first["updated_at"]) == ("900.00", "2024-03-01 12:00:00")
    assert "snapshot_date" not in first.asDict()


def test_distribution(spark, rows):
    summary = spark.createDataFrame(
        [("x", "open", "knight", 3, AT), ("x", "open", "druid", 4, AT), ("y", "open", "druid", 1, AT)],
        """world string, world_type string, vocation string, players_count bigint,
        updated_at timestamp""",
    )
    assert [tuple(r) for r in views.distribution(summary, "world").collect()] == [("x", 7), ("y", 1)]
    druids = views.summary_view(summary, vocations=["Druid"])
    assert [tuple(r) for r in views.distribution(druids, "vocation").collect()] == [("druid", 5)]
    assert tuple(views.distribution_kpis(summary).first()) == (8, 2, 2, AT)
    assert [r["players_count"] for r in views.summary_view(summary).collect()] == [4, 3, 1]


def test_player_kpis(spark):
    day = [datetime(2024, 1, d) for d in (1, 3, 4)]
    state = spark.createDataFrame(
        [("a", "x", "knight", 10, 100, "open", day[0], False),
         ("a", "y", "knight", 12, 300, "open", day[1], False),
         ("a", "x", "knight", 11, 250, "retro", day[2], True)],
        """name string, world string, vocation string, level int, experience bigint,
        world_type string, start_date timestamp, is_current boolean""",
    )
    progression = player_progression(state, AT)
    kpis = views.progression_kpis(progression).first().asDict()
    assert kpis == {
        "name": "a", "current_level": 11, "world": "x", "vocation": "knight", "world_type": "retro",
        "total_experience_gain": 150, "avg_xp_per_day": 25.0, "days_monitored": 3,
    }
    history = views.player_history(progression, "a")
    assert [r["current_level"] for r in history.collect()] == [12, 11]
    shown = views.progression_display(history).first()
    assert (shown["experience_gain"], shown["current_start_date"]) == ("200.00", "2024-01-03 00:00:00")
    assert names(views.find_players(progression, world="Y", text="A")) == ["a"]
    assert names(views.find_players(progression, vocation="druid")) == []


def test_skill_kpis_take_the_best_skill(spark):
    day = [datetime(2024, 1, d) for d in (1, 3, 3, 4)]
    state = spark.createDataFrame(
        [("a", "x", "axe", "knight", level, at, True) for level, at in zip((5, 9, 9, 7), day)],
        """name string, world string, category string, vocation string, skill_level int,
        start_date timestamp, is_current boolean""",
    ).dropDuplicates()
    kpis = views.skill_kpis(skills_progression(state, AT)).first().asDict()
    assert kpis == {
        "name": "a", "current_skill": 9, "world": "x", "vocation": "knight", "category": "axe",
        "total_skill_gain": 2, "avg_skill_per_day": 0.0, "days_monitored": 3,
    }


def test_options_and_counts(mart):
    assert [r[0] for r in views.filter_options(mart, "vocation").collect()] == [
        "druid", "knight", "monk"
    ]
    assert [tuple(r) for r in views.counts_by(mart, "vocation").collect()] == [
        ("druid", 8), ("knight", 4), ("monk", 4)
    ]
