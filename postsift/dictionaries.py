"""Default dictionaries, languages and communities, and the tables made from them.

All operators take their dictionary as an argument; these are the defaults. A caller's own
dictionary is a table in the ``DICT_TERMS`` schema, turned into a ``Dictionary`` by ``from_table``.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from postsift import schemas

# ---------------------------------------------------------------------------------------------
# Term lists, languages and communities. Results depend on the words and their order.
# ---------------------------------------------------------------------------------------------

PATTERN_LANGUAGES = [
    "japanese", "spanish", "french", "german", "italian", "portuguese", "korean", "chinese",
    "mandarin", "hindi", "russian", "vietnamese", "dutch", "filipino", "tagalog", "indonesian",
    "turkish",
]

PATTERNS = [
    "speak {}", "learning {}", "best way to learn {}", "fluency in {}", "practice speaking {}",
    "become conversational in {}", "conversational {}",
]

TRIGGERS = {
    "anxiety": [
        "afraid to speak", "scared to speak", "scared to talk", "nervous to speak",
        "anxiety when speaking", "speaking anxiety", "freeze up", "freeze up speaking",
        "freezing up", "freezing when", "blank out", "mind goes blank", "too shy",
        "embarrassed to speak", "embarrassed when", "frustrated", "overwhelmed",
        "losing motivation", "want to give up", "giving up", "stuck at", "hit a wall",
        "hit a plateau", "plateau", "can't understand natives", "too fast", "speak too fast",
    ],
    "urgency": [
        "moving to", "relocating to", "going to move", "moving in", "relocating in", "leaving in",
        "interview next", "presentation in", "visa requirement", "work visa", "need for job",
        "for my job", "starting job", "new job", "in-laws", "in laws", "partner's family",
        "partners family", "spouse's family", "boyfriend's family", "girlfriend's family",
        "meeting family", "job interview", "work trip", "business meeting", "business trip",
        "need to learn fast", "need to learn quickly", "deadline", "before i move",
        "before moving", "expat", "relocate", "relocation",
    ],
    "methods": [
        "duolingo isn't working", "duolingo doesn't work", "duolingo not helping",
        "quit duolingo", "beyond duolingo", "apps don't help", "apps aren't helping",
        "textbook isn't helping", "still can't speak", "can't speak", "can read but can't speak",
        "understand but can't speak", "years of studying", "studied for years",
        "been learning for", "learning for months", "learning for years",
    ],
    "heritage": [
        "heritage speaker", "lost my language", "can't speak to relatives",
        "in-laws don't speak", "bilingual couple", "language barrier relationship",
        "conversational fluency",
    ],
    "needs": [
        "conversation practice", "speaking practice", "speaking partner", "conversation partner",
        "language partner", "native speaker", "real conversations", "actual conversations",
        "practical speaking", "everyday conversation", "daily conversation", "survival phrases",
        "need to speak", "want to speak", "improve my speaking", "practice speaking",
    ],
    "level": [
        "intermediate", "upper intermediate", "advanced but", "b1", "b2", "c1",
        "conversational level", "can hold a conversation",
    ],
    "paying": [
        "tutor is expensive", "tutor is too expensive", "tutors are expensive", "tutor costs",
        "can't afford tutor", "cheaper than tutor", "worth the money", "worth paying",
        "willing to pay", "paid course", "paid app", "better than duolingo",
        "duolingo alternative", "beyond duolingo", "after duolingo", "italki alternative",
        "cheaper than italki", "invest in", "investment in",
    ],
}

EXCLUDES = {
    "tests": [
        "jlpt", "n1", "n2", "n3", "n4", "n5", "hsk", "topik", "dele", "delf", "dalf", "goethe",
        "telc", "cils", "celi", "toefl", "ielts", "test prep", "exam prep", "passing the",
        "pass the exam",
    ],
    "school": [
        "homework", "assignment", "class assignment", "school project", "university course",
        "college course", "quiz", "final exam", "midterm", "grade", "grading", "professor",
        "teacher said",
    ],
    "translation": [
        "translate this", "what does this mean", "help me translate", "can someone translate",
        "translation help", "what does this say", "how do you say",
    ],
    "media": [
        "anime", "manga", "light novel", "visual novel", "drama", "kdrama", "cdrama", "jdrama",
        "subtitles", "watch without subs", "raw anime", "webtoon",
    ],
    "off_topic": [
        "tattoo", "song lyrics", "lyrics translation", "game translation", "meme",
        "joke translation",
    ],
    "resources": [
        "best textbook", "textbook recommendation", "anki deck", "flashcard", "grammar guide",
        "what app", "which app", "youtube channel", "podcast recommendation",
    ],
    "free": [
        "free alternative", "free resource", "free app", "free course", "free version",
        "completely free", "for free", "without paying", "don't want to spend",
        "don't want to pay", "no money", "broke", "can't afford", "duolingo is enough",
        "duolingo works", "cracked", "pirated", "mod apk", "apk", "torrent", "$0",
        "zero dollars", "not spending",
    ],
}

LANGUAGES = [
    ("ja", "Japanese", "日本語", ["LearnJapanese", "japanese"]),
    ("en", "English", "English", ["EnglishLearning", "ENGLISH"]),
    ("es", "Spanish", "Español", ["learnspanish", "Spanish"]),
    ("fr", "French", "Français", ["French", "learnfrench"]),
    ("de", "German", "Deutsch", ["German", "learngerman"]),
    ("it", "Italian", "Italiano", ["italianlearning", "Italian"]),
    ("pt", "Portuguese", "Português", ["Portuguese", "learnportuguese"]),
    ("ko", "Korean", "한국어", ["Korean", "hanguk"]),
    ("zh", "Chinese", "中文", ["ChineseLanguage", "Chinese", "MandarinChinese"]),
    ("hi", "Hindi", "हिन्दी", ["Hindi", "learnHindi"]),
    ("ru", "Russian", "Русский", ["Russian", "learnRussian"]),
    ("vi", "Vietnamese", "Tiếng Việt", ["Vietnamese", "learnVietnamese"]),
    ("nl", "Dutch", "Nederlands", ["LearnDutch", "Dutch"]),
    ("fil", "Filipino", "Filipino", ["Tagalog", "Filipino"]),
    ("id", "Indonesian", "Bahasa Indonesia", ["Indonesian", "learnIndonesian"]),
    ("tr", "Turkish", "Türkçe", ["turkishlearning", "Turkish"]),
]

PRIORITY_CODES = ["fr", "en", "es", "ja", "de", "zh", "ko"]

COMMUNITIES = {
    "relocation": [
        "expats", "IWantOut", "digitalnomad", "movingtojapan", "japanlife", "movingtogermany",
        "germany", "askFrance", "movetocanada", "IWantToLeaveTheUS", "AmericanExpats",
        "chinalife", "Beijing", "Shanghai", "korea", "Living_in_Korea",
    ],
    "cultural": ["kpop", "kpophelp", "Korean"],
    "general": ["languagelearning", "language_exchange", "polyglot"],
}

# The six category labels, in listing order; the last one is the default.
CATEGORIES = [
    "Speaking Anxiety", "Practice Gap", "Immersion Prep", "Plateau Frustration", "App Fatigue",
    "General Learning",
]

# ---------------------------------------------------------------------------------------------
# Our own reading of the sections: what a hit in each section says about a post.
# ---------------------------------------------------------------------------------------------

SECTION_MEANING = {  # section: (category label, rubric signal)
    "anxiety": ("Speaking Anxiety", "anxiety"),
    "urgency": ("Immersion Prep", "urgency"),
    "methods": ("App Fatigue", None),
    "heritage": ("Immersion Prep", None),
    "needs": ("Practice Gap", None),
    "level": ("Plateau Frustration", None),
    "paying": ("App Fatigue", "paying"),
    "free": (None, "free"),
}


@dataclass(frozen=True)
class Term:
    kind: str
    ord: int
    term: str
    section: str | None = None
    category: str | None = None
    signal: str | None = None


@dataclass(frozen=True)
class Dictionary:
    """Trigger and exclude terms in dictionary order."""

    terms: tuple[Term, ...]

    def texts(self, kind: str) -> list[str]:
        return [t.term for t in self.terms if t.kind == kind]

    def with_signal(self, signal: str) -> list[str]:
        return [t.term for t in self.terms if t.signal == signal]

    def with_category(self, category: str) -> list[str]:
        return [t.term for t in self.terms if t.category == category]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t.kind, t.ord, t.term, t.section, t.category, t.signal) for t in self.terms]
        return spark.createDataFrame(rows, schemas.DICT_TERMS)

    @staticmethod
    def from_sections(triggers: dict, excludes: dict) -> "Dictionary":
        terms = []
        for kind, sections in (("trigger", triggers), ("exclude", excludes)):
            entries = [(section, term) for section, words in sections.items() for term in words]
            for ord_, (section, term) in enumerate(entries):
                category, signal = SECTION_MEANING.get(section, (None, None))
                terms.append(Term(kind, ord_, term, section, category, signal))
        return Dictionary(tuple(terms))

    @staticmethod
    def from_table(df: DataFrame) -> "Dictionary":
        """Read a dictionary table; it is a setting of the run, not data, and travels with every task."""
        rows = df.select("kind", "ord", "term", "section", "category", "signal").collect()
        return Dictionary(tuple(sorted((Term(*row) for row in rows), key=lambda t: (t.kind, t.ord))))


def generated_terms(patterns=PATTERNS, languages=PATTERN_LANGUAGES) -> list[str]:
    """Every pattern filled with every language, pattern by pattern."""
    return [pattern.format(language) for pattern in patterns for language in languages]


def default_dictionary() -> Dictionary:
    return Dictionary.from_sections({"generated": generated_terms(), **TRIGGERS}, EXCLUDES)


def languages_table(spark: SparkSession) -> DataFrame:
    priority = {code: i for i, code in enumerate(PRIORITY_CODES)}
    rows = [(*language, priority.get(language[0])) for language in LANGUAGES]
    return spark.createDataFrame(rows, schemas.LANGUAGES)


def communities_table(spark: SparkSession) -> DataFrame:
    rows = [(name, grp) for grp, names in COMMUNITIES.items() for name in names]
    return spark.createDataFrame(rows, schemas.COMMUNITIES)


def language_needles(languages=LANGUAGES, priority=PRIORITY_CODES) -> dict[str, str]:
    """Lower-cased name and native name to code, in priority order; unknown codes are ignored."""
    by_code = {code: (name, native) for code, name, native, *_ in languages}
    needles: dict[str, str] = {}
    for code in priority:
        for name in by_code.get(code, ()):
            needles.setdefault(name.lower(), code)
    return needles


def needles_from_table(languages: DataFrame) -> dict[str, str]:
    """``language_needles`` of a languages table."""
    listed = languages.where(F.col("priority").isNotNull())
    rows = listed.select("code", "name", "native_name", "priority").collect()
    ordered = [row.code for row in sorted(rows, key=lambda row: row.priority)]
    return language_needles([(row.code, row.name, row.native_name) for row in rows], ordered)


def term_table(names: DataFrame, patterns=PATTERNS) -> DataFrame:
    """Generated terms as a table from ``names(ord, name)``: each name fills every pattern.

    The pattern list is exploded per name, so no join is needed; (pattern_ord, name_ord) is the
    pattern-major order.
    """
    parts = F.array(*[F.struct(F.lit(i).alias("pattern_ord"), F.lit(p.split("{}")[0]).alias("head"),
                               F.lit(p.split("{}")[1]).alias("tail"))
                      for i, p in enumerate(patterns)])
    return (
        names.select(F.col("ord").alias("name_ord"), "name", F.inline(parts))
        .select("pattern_ord", "name_ord", F.concat("head", "name", "tail").alias("term"))
    )
