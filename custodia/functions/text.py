"""Rule-based redaction, entity counts, sentiment and topics as native column expressions.

Everything is row-local: no shuffle, no Python worker, whole texts. Quantifiers are bounded, or start
only where a run starts, so the cost per character stays bounded also on long unbroken runs. Personal names are found by a
given-name list or an honorific followed by a capitalised word; expect low recall there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

GIVEN_NAMES = (
    "Adam", "Alice", "Amir", "Anna", "Bob", "Carlos", "Carol", "Chen", "Clara", "David",
    "Diego", "Elena", "Emily", "Emma", "Erik", "Fatima", "Felix", "Grace", "Hanna", "Hugo",
    "Ines", "Ivan", "James", "Jane", "John", "Julia", "Karl", "Laura", "Lena", "Lisa",
    "Lucas", "Maria", "Marta", "Michael", "Nadia", "Nina", "Noah", "Olga", "Omar", "Oscar",
    "Paul", "Petra", "Robert", "Rosa", "Sarah", "Sofia", "Thomas", "Victor", "William", "Yusuf",
)

_STREET_WORDS = "Street|Avenue|Road|Boulevard|Lane|Drive|Court|Square|Ave|Blvd|Rd|Dr|Ln|Ct|St"
_WORD = "[A-Z][a-z]{1,30}"


@dataclass(frozen=True)
class Entity:
    """An entity type. ``body`` must not need lookaround.

    A match may not follow a character of ``before`` nor, if ``closed``, be followed by a word
    character. ``first`` lists the characters it can start with: testing those first lets the
    matcher pass over ordinary text several times faster and does not change what matches.
    """

    label: str
    body: str
    first: str = ""
    before: str = "0-9A-Za-z_"
    closed: bool = True

    @property
    def pattern(self) -> str:
        # boundaries spelled out: \b of Java 17 also counts non-ASCII letters as word characters
        first = f"(?={self.first})" if self.first else ""
        after = "(?![0-9A-Za-z_])" if self.closed else ""
        return f"{first}(?<![{self.before}]){self.body}{after}"


_MAILBOX = "A-Za-z0-9._%+-"  # its run is entered at the start only, so a long one is read once

# In the order of replacement: the longer and more specific forms first.
ENTITIES = (
    Entity("EMAIL", f"[{_MAILBOX}]+@[A-Za-z0-9.-]{{1,255}}[.][A-Za-z]{{2,24}}", before=_MAILBOX, closed=False),
    Entity("US_SOCIAL_SECURITY_NUMBER", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]"),
    Entity("CREDIT_CARD_NUMBER", "(?:[0-9]{4}[ -]?){3}[0-9]{4}", "[0-9]"),
    Entity("PHONE_NUMBER", "(?:[+]?1[ .-]?)?(?:[(][0-9]{3}[)] ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", "[0-9(+]"),
    Entity("IP_ADDRESS", "(?:[0-9]{1,3}[.]){3}[0-9]{1,3}", "[0-9]"),
    Entity("DATE_OF_BIRTH", "(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})", "[0-9]"),
    Entity(
        "STREET_ADDRESS",
        f"[0-9]{{1,5}} {_WORD} (?:{_STREET_WORDS})(?:, {_WORD}(?: {_WORD}){{0,2}} [A-Z]{{2}} [0-9]{{5}})?",
        "[0-9]",
    ),
    Entity("NAME", f"(?:(?:{'|'.join(GIVEN_NAMES)})|(?:Mr|Mrs|Ms|Dr)[.]?) {_WORD}(?:-{_WORD})?", "[A-Z]"),
)
LABELS = tuple(e.label for e in ENTITIES)


def _maybe_email(text: Column) -> Column:
    return F.contains(text, F.lit("@"))


def _maybe_number(text: Column) -> Column:
    return text.rlike("[0-9]")


_NUMERIC = frozenset(e.label for e in ENTITIES if "0-9" in e.first)


def redact(text: Column, labels: Sequence[str] | None = None) -> Column:
    """Replace entities by their ``[LABEL]``; all types, or only the chosen ones.

    Texts without an ``@`` skip the e-mail pass, texts without a digit all numeric passes.
    """
    unknown = set(labels or ()) - set(LABELS)
    if unknown:
        raise ValueError(f"unknown entity types: {sorted(unknown)}")

    def replace(value: Column, entity: Entity) -> Column:
        return F.regexp_replace(value, F.lit(entity.pattern), F.lit(f"[{entity.label}]"))

    chosen = [e for e in ENTITIES if labels is None or e.label in labels]
    out = text
    for entity in chosen:
        if entity.label == "EMAIL":
            out = F.when(_maybe_email(text), replace(out, entity)).otherwise(out)
    numeric = [e for e in chosen if e.label in _NUMERIC]
    if numeric:
        replaced = out
        for entity in numeric:
            replaced = replace(replaced, entity)
        out = F.when(_maybe_number(text), replaced).otherwise(out)
    for entity in chosen:
        if entity.label == "NAME":
            out = replace(out, entity)
    return out


def entity_counts(text: Column) -> list[Column]:
    """One count column per entity type, each on the original text."""

    def count(entity: Entity) -> Column:
        found = F.regexp_count(text, F.lit(entity.pattern))
        if entity.label == "EMAIL":
            found = F.when(_maybe_email(text), found).otherwise(0)
        elif entity.label in _NUMERIC:
            found = F.when(_maybe_number(text), found).otherwise(0)
        return found.cast("bigint").alias(entity.label)

    return [count(e) for e in ENTITIES]


POSITIVE = (
    "appreciated", "delighted", "excellent", "exceeded", "fast", "friendly", "glad", "good", "great",
    "happy", "helpful", "impressed", "love", "perfect", "pleased", "quick", "recommend", "resolved",
    "satisfied", "smooth", "thanks", "wonderful",
)
NEGATIVE = (
    "angry", "annoyed", "awful", "bad", "broken", "complaint", "damaged", "delayed", "disappointed",
    "error", "exposed", "fail", "failed", "issue", "late", "lost", "poor", "problem", "refund",
    "terrible", "unhappy", "wrong",
)


def _any_word(words: Sequence[str]) -> str:
    """A pattern for any of the lower-case words, standing alone.

    Three character classes turn most positions away before the boundary and the words are tried,
    and words are tried by their first letter; both only save time.
    """
    classes = "".join(f"[{''.join(sorted({w[i] for w in words}))}]" for i in range(3))
    by_initial = {initial: [w[1:] for w in words if w[0] == initial] for initial in sorted({w[0] for w in words})}
    listed = "|".join(f"{initial}(?:{'|'.join(rest)})" for initial, rest in by_initial.items())
    return f"(?={classes})(?<![0-9A-Za-z_])(?:{listed})(?![0-9A-Za-z_])"


WORDS_PATTERN = _any_word((*POSITIVE, *NEGATIVE))


def sentiment(text: Column) -> Column:
    """(p - n) / (p + n) over listed words, in [-1, 1]; 0 when none occurs, NULL for NULL.

    One pass finds the listed words; only those few are then told apart. Placeholders hold no
    listed word, so redaction does not move the score.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORDS_PATTERN), F.lit(0))

    def score(c: Column) -> Column:
        total = c["p"] + c["n"]
        return F.when(total == 0, 0.0).otherwise(F.round((c["p"] - c["n"]) / total, 4))

    def add(c: Column, word: Column) -> Column:
        positive = word.isin(list(POSITIVE)).cast("int")
        return F.struct((c["p"] + positive).alias("p"), (c["n"] + 1 - positive).alias("n"))

    return F.aggregate(words, F.struct(F.lit(0).alias("p"), F.lit(0).alias("n")), add, score)


def sentiment_label(score: Column, threshold: float) -> Column:
    return (
        F.when(score > threshold, "Positive").when(score < -threshold, "Negative").otherwise("Neutral")
    )


# Keywords per topic, first match wins.
TOPICS = (
    ("Refund Request", ("refund",)),
    ("Shipping Issue", ("shipping", "expedited")),
    ("Bulk Order", ("bulk", "wholesale")),
    ("Payment Issue", ("credit card",)),
    ("Urgent Issue", ("urgent", "privacy")),
)
DEFAULT_TOPIC = "General Feedback"


def topic(text: Column) -> Column:
    lower = F.lower(text)
    tests = []
    for label, words in TOPICS:
        test = F.contains(lower, F.lit(words[0]))
        for word in words[1:]:
            test = test | F.contains(lower, F.lit(word))
        tests.append((test, label))
    out = F.when(*tests[0])
    for test, label in tests[1:]:
        out = out.when(test, label)
    return out.otherwise(DEFAULT_TOPIC)
