"""Which dictionary terms does a text contain?

A term hits when its characters occur anywhere in the lower-cased text, also inside a longer word.
Results list the hits in dictionary order, a term listed twice twice.

Two ways to compute the same result:

* ``expressions``: ``contains`` per term inside one Catalyst expression. Cost grows with
  terms x text, so it serves short lists.
* ``automaton``: an Arrow-batched function that walks each text once for all terms of all lists
  together. Cost is nearly independent of the number of terms.

Measured on 10,000 texts (25 MB, local[8]): 16 terms 0.65 s against 0.42 s, 336 terms 5.8 s
against 0.5 s. The automaton is the default whatever the number of terms; it needs the package
pyahocorasick on the driver and on every executor. The expressions are used only on request.
"""

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from postsift.functions.text import bind


def matched_terms(text: Column, groups: Mapping[str, Sequence[str]], engine="automaton") -> Column:
    """A struct with one array of hit terms per group; NULL text has no hits."""
    lowered = F.lower(text)
    if engine == "automaton":
        return _automaton(groups)(lowered)
    return _expressions(lowered, groups)


def with_matches(df: DataFrame, text: Column, groups, name="hits", engine="automaton") -> DataFrame:
    """Add ``matched_terms`` as column ``name``, computed once per row.

    The value comes out of a one-element ``explode``. Without it the optimizer copies the scan
    into every filter and expression that mentions the result.
    """
    return df.select("*", F.explode(F.array(matched_terms(text, groups, engine))).alias(name))


def _expressions(lowered: Column, groups) -> Column:
    # Written inline, the lowered text would be computed per term.
    def hits(bound):
        return F.struct(*[
            F.filter(F.array(*[F.lit(t) for t in terms]).cast("array<string>"),
                     lambda term: F.contains(bound, term)).alias(group)
            for group, terms in groups.items()
        ])

    return bind(lowered, hits)


def _automaton(groups):
    import ahocorasick  # noqa: F401  an error here and now if the package is missing

    groups = {group: list(terms) for group, terms in groups.items()}
    places: dict[str, list[tuple[str, int]]] = {}
    for group, terms in groups.items():
        for position, term in enumerate(terms):
            places.setdefault(term, []).append((group, position))
    everywhere = places.pop("", [])  # the empty term is part of every text
    result = T.StructType([T.StructField(group, T.ArrayType(T.StringType())) for group in groups])

    @F.pandas_udf(result)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick as matcher

        automaton = matcher.Automaton()
        for term in places:
            automaton.add_word(term, term)
        if places:
            automaton.make_automaton()

        def find(text):
            hits = {group: [] for group in groups}
            if text is None:
                return hits
            found = {term for _, term in automaton.iter(text)} if places else ()
            spots = sorted({spot for term in found for spot in places[term]}.union(everywhere))
            for group, position in spots:
                hits[group].append(groups[group][position])
            return hits

        for texts in batches:
            yield pd.DataFrame([find(text) for text in texts], columns=list(groups))

    return scan


def first_language(hits: Column, needles: Mapping[str, str]) -> Column:
    """Code of the first hit among ``needles`` (name to code, in priority order), else NULL."""
    codes = F.create_map(*[F.lit(x) for pair in needles.items() for x in pair])
    first = F.get(hits, F.lit(0))
    return F.when(first.isNotNull(), codes[first])
