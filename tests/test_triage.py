import random

import pytest
from pyspark.sql import functions as F

from postsift import dictionaries as dic, schemas
from postsift.functions import text as tx
from postsift.functions.matching import with_matches
from postsift.operators import languages as la, triage
from postsift.sources import posts as ps

GOLDEN = [
    ("f1", "ana", "Scared to speak German at work", "New job starts soon and I freeze up in every meeting",
     "passed", ["speak german", "scared to speak", "freeze up", "new job"], "de"),
    ("f2", "ben", "Practice set for JLPT N3", "Which chapters matter", "excluded: jlpt, n3", [], None),
    ("f3", "cy", "Relocating to Lima and I still can't speak", "Reading is fine", "passed",
     ["relocating to", "still can't speak", "can't speak"], None),
    ("f4", "[deleted]", "Scared to speak Korean", "Any tips", "deleted_author", [], None),
    ("f5", "dee", "Frustrated with my French", "Films are fine with subtitles on", "excluded: subtitles", [], None),
    ("f6", "eli", "Lunch thread", "What did you eat", "no_trigger", [], None),
    ("f7", "fay", "Want to quit", "can't afford tutor prices", "excluded: can't afford", [], None),
    ("f8", "gus", "Life beyond Duolingo", "Ideas", "passed", ["beyond duolingo", "beyond duolingo"], None),
    ("f9", "hal", "Upgrade my speaking practice", "Any plan", "excluded: grade", [], None),
    ("f10", "ida", "I can’t speak at all", "Curly quote", "no_trigger", [], None),
    ("f11", "jo", "French or Spanish", "plateau in both, learning Spanish now", "passed", ["learning spanish", "plateau"], "fr"),
    ("f12", "kim", "日本語 plateau", "", "passed", ["plateau"], "ja"),
    ("f13", "lu", "Learning Russian", "new here", "passed", ["learning russian"], None),
]


def make_posts(spark, rows):
    data = [
        (i, id_, "languagelearning", author, title, body, "u", f"/r/languagelearning/comments/{id_}/x/", 1702800000.0, 1, 2)
        for i, (id_, author, title, body) in enumerate(rows)
    ]
    return spark.createDataFrame(data, schemas.POSTS)


@pytest.fixture(scope="module")
def golden(spark):
    return make_posts(spark, [row[:4] for row in GOLDEN])


@pytest.mark.parametrize("engine", ["expressions", "automaton"])
def test_golden_verdicts(golden, engine):
    rows = {r.id: r for r in triage.classify(golden, engine=engine).collect()}
    for id_, *_, reason, triggers, language in GOLDEN:
        assert (rows[id_].reason, rows[id_].matched_triggers, rows[id_].language_detected) == (reason, triggers, language)
        assert rows[id_].passed == (reason == "passed")


def test_golden_funnel(golden):
    row = triage.funnel(triage.classify(golden)).first()
    assert (row.total, row.passed, row.no_trigger, row.excluded, row.deleted_author) == (13, 6, 2, 4, 1)
    assert row.pass_rate_text == "46.2%"


def test_empty_funnel_has_no_rate(golden):
    row = triage.funnel(triage.classify(golden.where("false"))).first()
    assert (row.total, row.pass_rate, row.pass_rate_text) == (0, None, "N/A")


def test_rate_rounds_halves_to_even(spark):
    rate = spark.range(1).select(tx.percent_text(F.lit(49), F.lit(400))).first()[0]
    assert rate == "12.2%"


def test_modes(golden):
    kept = {r.id: r for r in triage.classify(golden, exclude_on_match=False).collect()}
    assert kept["f7"].reason == "passed" and kept["f7"].matched_excludes == ["can't afford"]
    assert kept["f2"].reason == "no_trigger" and kept["f2"].matched_excludes == []
    loose = {r.id: r for r in triage.classify(golden, require_trigger=False).collect()}
    assert loose["f6"].reason == "passed" and loose["f6"].matched_triggers == []
    assert loose["f4"].reason == "deleted_author"


def test_engines_agree_with_a_plain_loop(spark):
    rng = random.Random(5)
    alphabet = "abcé '"
    word = lambda top: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, top)))
    triggers, excludes = [word(3) for _ in range(30)], [word(4) for _ in range(20)]
    texts = [word(60).upper() for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    want = {
        n: ([t for t in triggers if t in text.lower()], [e for e in excludes if e in text.lower()]) if text else ([], [])
        for n, text in enumerate(texts)
    }
    for engine in ("expressions", "automaton"):
        rows = with_matches(df, F.col("text"), {"t": triggers, "e": excludes}, engine=engine).collect()
        got = {r.n: (r.hits.t, r.hits.e) for r in rows}
        assert got == want, engine


def test_empty_group(spark):
    df = spark.createDataFrame([("abc",)], "text string")
    for engine in ("expressions", "automaton"):
        hits = with_matches(df, F.col("text"), {"t": ["b", ""], "none": []}, engine=engine).first().hits
        assert (hits.t, hits.none) == (["b", ""], [])


def test_scan_runs_once_per_row(golden):
    plan = triage.classify(golden, engine="automaton").where("passed")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plan = triage.classify(golden, engine="expressions").where("passed")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("beyond duolingo") <= 2 and plan.count("Generate explode") == 1


def test_dictionary_sizes_and_table_round_trip(spark):
    default = dic.default_dictionary()
    triggers = default.texts("trigger")
    assert (len(triggers), len(set(triggers)), len(default.texts("exclude"))) == (247, 246, 91)
    again = dic.Dictionary.from_table(default.table(spark))
    assert again.texts("trigger") == triggers and again.texts("exclude") == default.texts("exclude")


def test_generated_terms_are_pattern_major(spark):
    names = spark.createDataFrame(list(enumerate(dic.PATTERN_LANGUAGES)), "ord int, name string")
    rows = dic.term_table(names).orderBy("pattern_ord", "name_ord").collect()
    assert [r.term for r in rows] == dic.generated_terms() == dic.default_dictionary().texts("trigger")[:119]


def test_needles_from_a_table(spark):
    assert list(dic.needles_from_table(dic.languages_table(spark)).items()) == list(dic.language_needles().items())


def test_monitored_communities(spark):
    rows = la.monitored_communities(dic.languages_table(spark), dic.communities_table(spark)).collect()
    names = [r.name for r in rows]
    assert len(names) == 36 and names == sorted(names) and "Korean" in names and "learnRussian" not in names


def test_language_tables(spark):
    languages = dic.languages_table(spark)
    assert [r.code for r in la.priority_languages(languages).collect()] == dic.PRIORITY_CODES
    assert languages.select(F.explode("subreddits")).count() == 33
    assert la.language_names(languages).count() == 32
    listing = {r.code: r.communities for r in la.language_listing(languages).collect()}
    assert listing["zh"] == "ChineseLanguage, Chinese, MandarinChinese"


def test_lead_from_post(golden):
    lead = triage.to_leads(triage.classify(golden), "2024-01-01 00:00:00").where("post_id = 'f1'").first()
    assert lead.post_url == "https://reddit.com/r/languagelearning/comments/f1/x/"
    assert lead.message_url == "https://reddit.com/message/compose/?to=ana"
    assert str(lead.created_at) == "2023-12-17 08:00:00"
    assert (lead.status, lead.sent, lead.signal_score, lead.comment_worthy) == ("new", False, None, None)


def test_sample_posts_flow(spark):
    posts = ps.normalise(ps.open_posts(spark))
    rows = {r.id: r.reason for r in triage.classify(posts).collect()}
    assert rows["f1"] == rows["f8"] == rows["f11"] == rows["f12"] == "passed"
    assert (rows["f4"], rows["f6"], rows["f9"]) == ("deleted_author", "no_trigger", "excluded: grade")
    assert ps.sample_posts(spark, 3).count() == 3
