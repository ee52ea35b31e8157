"""Line rules judge a line by what most of it is, however long it is."""

import random

from pyspark.sql import functions as F

from postsift.llm import line_quality

def prose(seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))


PROSE, MORE = prose(1), prose(2)
GOOD = [
    "Il dit « oui », elle dit « non » et les autres « peut-être », sans jamais « conclure » la discussion.",
    PROSE + " Then click here and Log in. " + MORE, PROSE + " The site sets a cookie for JavaScript users. " + MORE,
    PROSE + " Home | News | About | Contact | " + MORE, PROSE + " ha ha ha ha ha ha ha " + MORE, "a » b « c » d « e » f",
]
BAD = ["Home | News | About | Contact", "Home > News > World > Europe >", "Start » Blog » Archiv » 2019", "All rights reserved.",
       "Please enable JavaScript to view this page.", "Log in or Sign up to read on.", "no " * 30 + "end of line"]


def test_rules_are_relative_to_the_line(spark):
    lines = spark.createDataFrame([(x,) for x in GOOD + BAD], "line string")
    failed = [r.line for r in lines.where(line_quality.line_fails(F.col("line"))).collect()]
    assert sorted(failed) == sorted(BAD)
    docs = spark.createDataFrame(list(enumerate(GOOD[1:5])), "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in line_quality.filtered(docs).collect()) == list(enumerate(GOOD[1:5]))
