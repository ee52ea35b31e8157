"""Scores, categories, worthiness and drafts: request tables out, answer tables in.

Answers come from whatever the caller runs between the two tables. ``rubric`` scores without any
answers, and ``with_scorer`` plugs in a function of the caller's.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postsift.dictionaries import CATEGORIES, Dictionary, default_dictionary
from postsift.functions import jsontext as js, text as tx
from postsift.functions.sampling import chosen, pick
from postsift.operators.lookup import lookup
from postsift.operators.numbering import with_batch

# What a score answer means when a key is absent.
SCORE_RANGE = (1, 10)
DEFAULT_SCORE, DEFAULT_TYPE, DEFAULT_CATEGORY = 5, "MEDIUM", "General Learning"

# Size limits and sampling temperature of each kind of request.
BATCH_SIZE = 5
SCORE_TOKENS, BATCH_TOKENS, WORTHY_TOKENS, PUBLIC_TOKENS, DM_TOKENS = 1024, 2000, 200, 500, 200
JSON_TEMPERATURE, TEXT_TEMPERATURE = 0.3, 0.7
BODY_CHARS, BATCH_BODY_CHARS, BATCH_TRIGGERS = 1000, 500, 5
MENTION_PROBABILITY = 0.2

# Points per rubric signal. The base is the default score.
RUBRIC_POINTS = {"urgency": 3, "paying": 2, "anxiety": 2, "free": -5}

# Stand-ins for a blank category or language in a direct-message request.
DM_CATEGORY, DM_LANGUAGE = "language learning challenges", "a new language"

# Reasons recorded when there is no usable worthiness answer.
REASON_OFF = "Skipped evaluation - API not configured"
REASON_NO_ANSWER = "Evaluation failed - defaulting to worthy"
REASON_UNREADABLE = "Parse error - defaulting to worthy"
REASON_OTHER = "Error - defaulting to worthy"
REASON_ABSENT = "No reason provided"

SCORE_TEMPLATE = (
    "Rate this post from r/{subreddit} from 1 to 10 and name its category.\n"
    "Title: {title}\nText: {body}\nKeywords: {triggers}\n"
    'Answer as JSON: {{"score": n, "signal_type": "HIGH|MEDIUM|LOW", "category": "...", "reasoning": "..."}}'
)
WORTHY_TEMPLATE = (
    "Is this post from r/{subreddit} asking for advice that a reply could give?\n"
    "Title: {title}\nText: {body}\nScore: {signal_score}/10\nCategory: {category}\n"
    'Answer as JSON: {{"worthy": true, "reason": "..."}}'
)


# --- rubric -----------------------------------------------------------------------------------

def band(score: Column) -> Column:
    return F.when(score >= 8, "HIGH").when(score >= 5, "MEDIUM").when(score.isNotNull(), "LOW")


def _hits(hits: Column, terms: list[str]) -> Column:
    return F.filter(hits, lambda hit: hit.isin(terms)) if terms else F.array().cast("array<string>")


def rubric(leads: DataFrame, dictionary: Dictionary | None = None, hits=("matched_triggers",)) -> DataFrame:
    """Fill signal_score, signal_type and category from the terms already matched.

    Each signal counts once, however many of its terms hit. The category is the one with most
    hits, the earlier in the listing on a tie, and the default without any.
    """
    dictionary = dictionary or default_dictionary()
    found = F.flatten(F.array(*[F.coalesce(F.col(h), F.array().cast("array<string>")) for h in hits]))
    points = sum(
        (F.when(F.size(_hits(F.col("_found"), dictionary.with_signal(s))) > 0, p).otherwise(0)
         for s, p in RUBRIC_POINTS.items()),
        F.lit(DEFAULT_SCORE),
    )
    counts = [
        F.struct(F.size(_hits(F.col("_found"), dictionary.with_category(c))).alias("n"),
                 F.lit(-i).alias("rank"), F.lit(c).alias("label"))
        for i, c in enumerate(CATEGORIES[:-1])
    ]
    best = F.array_max(F.array(*counts))
    score = F.greatest(F.lit(1), F.least(F.lit(10), points)).cast("int")
    return (
        leads.withColumn("_found", found)
        .withColumn("signal_score", score)
        .withColumns({
            "signal_type": band(F.col("signal_score")),
            "category": F.when(best["n"] > 0, best["label"]).otherwise(DEFAULT_CATEGORY),
        })
        .drop("_found")
    )


def with_scorer(leads: DataFrame, scorer, schema) -> DataFrame:
    """Run ``scorer(pandas batches) -> pandas batches`` over the leads; it must be repeatable per row."""
    return leads.mapInPandas(scorer, schema)


# --- score requests and answers ---------------------------------------------------------------

def score_requests(leads: DataFrame, template=SCORE_TEMPLATE) -> DataFrame:
    """One request per lead."""
    prompt = js.fill(
        template, subreddit=F.col("subreddit"), title=F.col("title"),
        body=tx.clip(F.col("body"), BODY_CHARS), triggers=F.array_join("matched_triggers", ", "))
    return _requests(leads, "score", prompt, SCORE_TOKENS, JSON_TEMPERATURE)


def _requests(leads, kind: str, prompt: Column, tokens: int, temperature: float) -> DataFrame:
    return leads.select(
        F.concat(F.lit(f"{kind}:"), F.col("seq").cast("string")).alias("request_id"), "seq", "post_id",
        F.lit(kind).alias("kind"), prompt.alias("prompt"),
        F.lit(tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"),
        F.lit(temperature == JSON_TEMPERATURE).alias("json_answer"),
    )


def json_mode(json_answer: Column, model: Column, prefix: str) -> Column:
    """JSON mode is asked for only where the model family knows it."""
    return json_answer & model.startswith(prefix)


def batch_requests(leads: DataFrame, size=BATCH_SIZE) -> DataFrame:
    """One request per batch of ``size`` leads, the posts as a JSON array in order."""
    post = F.struct(
        F.col("post_id").alias("id"), "subreddit", "title",
        tx.clip(F.col("body"), BATCH_BODY_CHARS).alias("body"),
        F.array_join(F.slice("matched_triggers", 1, BATCH_TRIGGERS), ", ").alias("triggers"),
    )
    # Bodies are cut before the shuffle. A batch never exceeds ``size``, so its list is bounded.
    batches = with_batch(leads.select("seq", post.alias("post")), size).groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.sort_array(F.collect_list(F.struct("batch_pos", "post"))).alias("_posts"))
    return batches.select(
        "batch_no", "n_posts", F.to_json("_posts.post").alias("posts_json"),
        F.lit(BATCH_TOKENS).alias("max_tokens"), F.lit(JSON_TEMPERATURE).alias("temperature"),
    )


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with ``value`` worked out once per row.

    A filter or a second use over a plain projection would carry a copy of the whole expression; the
    optimizer doesn't look into the generator of a one-element list.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def score_fields(value: Column) -> list[Column]:
    return [
        js.field_or(value, "score", "int", DEFAULT_SCORE).alias("signal_score"),
        js.field_or(value, "signal_type", "string", DEFAULT_TYPE).alias("signal_type"),
        js.field_or(value, "category", "string", DEFAULT_CATEGORY).alias("category"),
    ]


def parse_score_answers(answers: DataFrame) -> DataFrame:
    """``answers(..., raw)`` with extracted, signal_score, signal_type, category and needs_retry.

    Anything but a JSON object leaves the three fields NULL and asks for a retry.
    """
    bare = answers.drop("extracted", "_value", "signal_score", "signal_type", "category", "needs_retry")
    parsed = _once(_once(bare, js.extract_json(F.col("raw")), "extracted"), js.parse_json(F.col("extracted")), "_value")
    good = js.is_object(F.col("_value"))
    fields = [F.when(good, c).alias(n) for c, n in zip(
        score_fields(F.col("_value")), ("signal_score", "signal_type", "category"))]
    return parsed.select(*bare.columns, "extracted", *fields, (~good).alias("needs_retry"))


def quarantined_scores(parsed: DataFrame) -> DataFrame:
    """Rows of ``parse_score_answers`` that hold no score from 1 to 10, with the cause.

    The other rows are ``parsed`` without these; whoever applies scores decides what to leave out.
    """
    cause = (
        F.when(F.col("needs_retry"), "unreadable").when(F.col("signal_score").isNull(), "no score")
        .when(~F.col("signal_score").between(*SCORE_RANGE), "out of range"))
    return parsed.withColumn("cause", cause).where(F.col("cause").isNotNull())


def one_answer(answers: DataFrame, key: str) -> DataFrame:
    """(key, raw): of several answers to one request the last to arrive, by ``arrived`` if there is such a column."""
    order = ["arrived", "raw"] if "arrived" in answers.columns else ["raw"]
    return answers.groupBy(key).agg(F.max_by("raw", F.struct(*order)).alias("raw"))


def parse_batch_answers(batch_answers: DataFrame, *more: str) -> DataFrame:
    """``batch_answers(batch_no, raw)`` as (batch_no, usable, items), with the columns named in ``more``.

    Usable is an array of objects. An empty object or text has no items and is usable too: its
    leads simply stay unscored. Ids must be JSON text.
    """
    extracted = _once(batch_answers.select("batch_no", *more, "raw"), js.extract_json(F.col("raw")), "_text")
    parsed = _once(extracted, js.parse_json(F.col("_text")), "_value")
    kind = F.schema_of_variant("_value")
    items = js.items(F.col("_value"))
    all_objects = F.coalesce(F.forall(items, js.is_object), F.lit(False))
    empty = (kind == "OBJECT<>") | ((kind == "STRING") & (F.try_variant_get("_value", "$", "string") == ""))
    scored = F.transform(items, lambda item: F.struct(js.text_field(item, "id").alias("id"), *score_fields(item)))
    return parsed.select(
        "batch_no", *more, F.coalesce(all_objects | empty, F.lit(False)).alias("usable"),
        F.when(all_objects, scored).alias("items"),
    )


def retry_batches(batches: DataFrame, batch_answers: DataFrame) -> DataFrame:
    """``batches(batch_no, ...)`` whose answer is missing or unusable: their leads are asked singly."""
    usable = parse_batch_answers(one_answer(batch_answers, "batch_no")).where("usable").select("batch_no")
    return batches.join(usable, "batch_no", "left_anti")


def retry_requests(leads: DataFrame, batch_answers: DataFrame, template=SCORE_TEMPLATE, size=BATCH_SIZE) -> DataFrame:
    """Single requests for the leads of batches whose answer is missing or unusable."""
    alone = retry_batches(with_batch(leads.select("seq"), size), batch_answers)
    return score_requests(leads.join(alone.select("seq"), "seq", "left_semi"), template)


def apply_batch_scores(leads: DataFrame, batch_answers: DataFrame, single_answers: DataFrame | None = None,
                       size=BATCH_SIZE) -> DataFrame:
    """Leads with scores from batch answers, and from single answers where a batch was unusable.

    ``single_answers(seq, raw)``. A lead takes the last item with its id in the answer of its own
    batch; leads that a usable answer does not mention stay unscored. The join keys are the batch,
    which has at most ``size`` leads, and the unique seq, so neither can be hot. Numbers and scores are
    worked out on ids alone; the leads themselves are joined once. Of several answers to a batch or
    a lead the last counts.
    """
    fields = ("signal_score", "signal_type", "category")
    parsed = parse_batch_answers(one_answer(batch_answers, "batch_no"))
    rows = with_batch(leads.select("seq", "post_id"), size).join(parsed, "batch_no", "left")
    own = F.filter("items", lambda item: item["id"] == F.col("post_id"))
    rows = rows.withColumn("_score", F.try_element_at(own, F.lit(-1)))
    if single_answers is None:
        scores = rows.select("seq", *[F.col(f"_score.{n}") for n in fields])
        return leads.drop(*fields).join(scores, "seq", "left").select(leads.columns)
    singles = parse_score_answers(one_answer(single_answers, "seq")).select("seq", F.struct(*fields).alias("_single"))
    usable = F.coalesce("usable", F.lit(False))
    scores = rows.join(singles, "seq", "left").select("seq", *[
        F.when(usable, F.col(f"_score.{n}")).otherwise(F.col(f"_single.{n}")).alias(n) for n in fields])
    return leads.drop(*fields).join(scores, "seq", "left").select(leads.columns)


def apply_scores(leads: DataFrame, scores: DataFrame) -> DataFrame:
    """Leads with ``scores(post_id, pos, signal_score, signal_type, category)`` joined by id.

    The last score of an id wins; leads without one keep NULL.
    """
    last = scores.groupBy("post_id").agg(
        F.max_by(F.struct("signal_score", "signal_type", "category"), "pos").alias("_s"))
    bare = leads.drop("signal_score", "signal_type", "category")
    return lookup(bare, last.select("post_id", "_s.*"), "post_id").select(leads.columns)


# --- worthiness and drafts --------------------------------------------------------------------

def worthy_requests(leads: DataFrame, template=WORTHY_TEMPLATE) -> DataFrame:
    prompt = js.fill(
        template, subreddit=F.col("subreddit"), title=F.col("title"),
        body=tx.clip(F.col("body"), BODY_CHARS), signal_score=tx.number_or(F.col("signal_score"), "N/A"),
        category=tx.text_or(F.col("category"), DEFAULT_CATEGORY))
    return _requests(leads, "worthy", prompt, WORTHY_TOKENS, JSON_TEMPERATURE)


def apply_worthiness(leads: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Fill comment_worthy and comment_worthy_reason from ``answers(seq, raw)``.

    Without a usable answer a lead counts as worthy, with the cause as reason. ``None`` stands
    for evaluation switched off.
    """
    if answers is None:
        return leads.withColumns({
            "comment_worthy": F.lit(True), "comment_worthy_reason": F.lit(REASON_OFF)})
    parsed = _once(one_answer(answers, "seq").select("seq", "raw"), js.extract_json(F.col("raw")), "_text")
    parsed = _once(parsed, js.parse_json(F.col("_text")), "_value")
    value = F.col("_value")
    flag = F.try_variant_get(value, "$.worthy", "variant")
    # A value that is not a JSON boolean counts by its truth; a false one gives NULL: no drafts,
    # yet not counted as judged unworthy.
    kind = F.schema_of_variant(flag)
    other = (
        F.when(kind == "STRING", F.try_variant_get(flag, "$", "string") != "")
        .when(kind.startswith("ARRAY"), F.size(js.items(flag)) > 0)
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.try_variant_get(flag, "$", "double") != 0)
    )
    worthy = (
        F.when(flag.isNull(), True)
        .when(kind == "BOOLEAN", F.try_variant_get(flag, "$", "boolean"))
        .when(other, True)
    )
    missing = F.coalesce("_text", F.lit("")) == ""
    verdict = (
        F.when(missing, F.struct(F.lit(True).alias("worthy"), F.lit(REASON_NO_ANSWER).alias("reason")))
        .when(value.isNull(), F.struct(F.lit(True).alias("worthy"), F.lit(REASON_UNREADABLE).alias("reason")))
        .when(~js.is_object(value), F.struct(F.lit(True).alias("worthy"), F.lit(REASON_OTHER).alias("reason")))
        .otherwise(F.struct(worthy.alias("worthy"), js.field_or(value, "reason", "string", REASON_ABSENT).alias("reason")))
    )
    judged = parsed.select("seq", verdict.alias("_verdict"))
    rows = leads.drop("comment_worthy", "comment_worthy_reason").join(judged, "seq", "left")
    unanswered = F.col("_verdict").isNull()
    return rows.withColumns({
        "comment_worthy": F.when(unanswered, True).otherwise(F.col("_verdict.worthy")),
        "comment_worthy_reason": F.when(unanswered, REASON_NO_ANSWER).otherwise(F.col("_verdict.reason")),
    }).select(leads.columns)


def unworthy_count(leads: DataFrame) -> DataFrame:
    """Leads judged not worthy; a missing judgement does not count."""
    return leads.agg(F.count_if(~F.col("comment_worthy")).alias("unworthy"))


def assign_mention(leads: DataFrame, probability=MENTION_PROBABILITY, seed="0") -> DataFrame:
    """Record for each lead whether its draft may mention the product."""
    return leads.withColumn("mention_allowed", chosen(F.col("post_id"), probability, seed))


def draft_requests(leads: DataFrame, templates: dict, require_worthy=True, model=None, mentions=()) -> DataFrame:
    """Public and DM draft requests for worthy leads, from the caller's templates.

    ``templates`` has the keys ``public`` (used where no mention is allowed), ``public_mention``
    and ``dm``; ``public_mention`` may hold ``{mention}``, one of the caller's ``mentions``, drawn evenly by
    post id. With ``model`` the rows name the model to ask.
    """
    mention = F.lit("")
    if mentions:
        mention = F.element_at(F.array(*[F.lit(text) for text in mentions]), pick(F.col("post_id"), len(mentions)) + 1)
    chosen_leads = leads.where("comment_worthy") if require_worthy else leads
    shared = {"subreddit": F.col("subreddit"), "title": F.col("title"), "body": tx.clip(F.col("body"), BODY_CHARS)}
    public = F.when(
        F.coalesce("mention_allowed", F.lit(False)),
        js.fill(templates["public_mention"], **shared, mention=mention, category=tx.text_or(F.col("category"), DEFAULT_CATEGORY)),
    ).otherwise(js.fill(templates["public"], **shared))
    direct = js.fill(
        templates["dm"], title=F.col("title"),
        category=tx.text_or(F.col("category"), DM_CATEGORY),
        language=tx.text_or(F.col("language_detected"), DM_LANGUAGE))
    requests = F.array(
        F.struct(F.lit("public").alias("kind"), public.alias("prompt"), F.lit(PUBLIC_TOKENS).alias("max_tokens")),
        F.struct(F.lit("dm").alias("kind"), direct.alias("prompt"), F.lit(DM_TOKENS).alias("max_tokens")),
    )
    rows = chosen_leads.select("seq", "post_id", "mention_allowed", F.inline(requests)).select(
        F.concat_ws(":", "kind", F.col("seq").cast("string")).alias("request_id"), "*",
        F.lit(TEXT_TEMPERATURE).alias("temperature"))
    return rows if model is None else rows.withColumn("model", F.lit(model))


def for_model(requests: DataFrame, model: str, json_prefix: str) -> DataFrame:
    """Requests with the model to ask, and JSON mode where JSON is wanted and the model's family knows it."""
    return requests.withColumns({
        "model": F.lit(model), "json_mode": json_mode(F.col("json_answer"), F.lit(model), json_prefix)})


def apply_drafts(leads: DataFrame, answers: DataFrame) -> DataFrame:
    """Fill public_draft and dm_draft from ``answers(seq, kind, text)``."""
    drafts = answers.groupBy("seq").agg(
        F.max(F.when(F.col("kind") == "public", F.col("text"))).alias("_public"),
        F.max(F.when(F.col("kind") == "dm", F.col("text"))).alias("_dm"))
    rows = leads.join(drafts, "seq", "left")
    return rows.withColumns({
        "public_draft": F.coalesce("_public", "public_draft"),
        "dm_draft": F.coalesce("_dm", "dm_draft"),
    }).select(leads.columns)
