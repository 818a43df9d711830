import pytest
from pyspark.sql import functions as F

from replylane.functions.rules import FlagSet, RuleSet, first_match, match_table
from replylane.packs import airline

RULES = airline.rules("StarMiles")

# One text per pattern, in the order of the patterns, and one near miss.
POSITIVES = {
    "refund_compensation_request": [
        "i want a refund", "please reimburse me", "compensation please", "can you waive it",
        "the fees waived", "credit voucher", "my money back", "the change fee", "an extra fee",
        "why was i charged",
    ],
    "baggage_issue": [
        "bags have been lost", "no bag here", "the gate-check line", "my carry on",
        "a suitcase", "lost my bag", "at baggage claim",
    ],
    "flight_disruption": [
        "so delayed", "they cancelled", "missed connection", "we got diverted",
        "stuck on the plane", "no crew", "grounded", "rebooking", "another hour",
        "sitting on the tarmac", "a gate change",
    ],
    "booking_checkin_issue": [
        "check-in", "boarding pass", "seat assignment", "can’t book", "a reservation",
        "booking a flight", "won't recline", "wrong terminal", "app isn't nice",
    ],
    "upgrade_loyalty": [
        "an upgrade", "my starmiles", "gold status", "my miles", "first class seat available",
        "elite status",
    ],
    "praise_thanks": [
        "many thanks", "kudos", "shout-out", "appreciate", "lovely crew", "thanks all", "well done",
    ],
    "service_complaint": [
        "worst airline", "so rude", "disgusted", "unacceptable", "discriminating", "no remorse",
        "horrible", "terrible service", "fuuuck", "never flying again", "let down",
        "get it together", "this sucks", "ridiculous", "pathetic", "unethical", "awful",
        "shame on you", "disappointed", "shouldn't have to",
    ],
    "info_question": [
        "is it late?  ", "any chance", "how long", "what gate", "is there", "can i", "will we",
    ],
}
NEAR_MISSES = [
    "refunded", "bagel shop", "delaying", "reservations", "upgrades", "thankful", "rudeness",
    "what?no", "prefund", "kudosé", "mileséa",
]


@pytest.mark.parametrize("label", list(POSITIVES))
def test_every_pattern_has_a_hit(column, label):
    patterns = dict(RULES.rules)[label]
    assert len(POSITIVES[label]) == len(patterns)
    found = column(POSITIVES[label], lambda c: F.transform(RULES.matches(c), lambda m: m["pattern"]))
    for pattern, hits in zip(patterns, found):
        assert pattern in hits
    assert set(column(POSITIVES[label], RULES.label)) == {label}


def test_near_misses(column):
    assert set(column(NEAR_MISSES, RULES.label)) == {"other_unclear"}


def test_priority_and_default(column):
    values = [
        "thanks for the worst airline ever", "is my flight delayed?", "refund my lost bag", "",
        None, "hm", "what a day?",
    ]
    assert column(values, RULES.label) == [
        "praise_thanks", "flight_disruption", "refund_compensation_request", "other_unclear",
        "other_unclear", "other_unclear", "info_question",
    ]
    assert column(values, RULES.matched_rule) == [6, 3, 1, None, None, None, 8]


def test_known_messages(column):
    values = [
        "thanks, the cabin team was lovely",
        "our flight is delayed since noon and nobody says why",
        "please refund us, the third time you cancelled our trip",
        "why can I not check in on my phone",
        "I call this discrimination, my lawyer will write to you",
        "nobody was there at baggage claim and my bag is missing",
        "it never showed up and we waited till midnight",
    ]
    assert column(values, RULES.label) == [
        "praise_thanks", "flight_disruption", "refund_compensation_request",
        "booking_checkin_issue", "service_complaint", "baggage_issue", "other_unclear",
    ]
    flags = FlagSet(airline.FLAGS)
    assert column(values[:5], flags.detect) == [
        [], [], ["repeated_failure", "explicit_compensation_or_refund"], [],
        ["discrimination_or_legal"],
    ]


def test_every_flag(column):
    flags = FlagSet(airline.FLAGS)
    values = [
        "a medical case", "i will sue", "not again", "an elite guest", "10 years flying",
        "the worst day ever", "a voucher", "miles are missing", "again, refund!", "against",
    ]
    assert column(values, flags.detect) == [
        ["safety_or_medical"], ["discrimination_or_legal"], ["repeated_failure"],
        ["premium_customer_risk"], ["premium_customer_risk"], ["strong_anger"],
        ["explicit_compensation_or_refund"], ["account_specific_dispute"],
        ["repeated_failure", "explicit_compensation_or_refund"], [],
    ]


def test_pattern_count():
    assert [len(p) for _, p in RULES.rules] == [10, 7, 11, 9, 6, 7, 20, 7]
    assert len(airline.FLAGS) == 7 and sum(airline.QUOTAS.values()) == 195


def test_rules_from_a_table(spark, column):
    table = spark.createDataFrame(
        [(2, "b", "dog"), (1, "a", "cat"), (1, "a", "lion")],
        "priority int, label string, pattern string",
    )
    rules = RuleSet.from_table(table, "none")
    assert rules.labels == ["a", "b", "none"]
    assert column(["dog and lion", "a dog", "x"], rules.label) == ["a", "b", "none"]


def test_match_table_agrees_with_the_chain(spark):
    data = [(i, t) for i, t in enumerate(sum(POSITIVES.values(), []))]
    df = spark.createDataFrame(data, "id int, text string")
    table = first_match(match_table(df, "id", "text", RULES), "id")
    chain = df.select("id", RULES.label(F.col("text")).alias("label"))
    assert table.exceptAll(chain).count() == 0 and table.count() == len(data)


def test_back_references_and_open_alternations(column):
    rules = RuleSet((("twice", (r"\b(ab)c", r"(x+)y\1", r"\bone|two\b")),), "none")
    values = ["abc", "xxyxx", "xyz", "one", "stwo", "zabc", "two's"]
    assert column(values, rules.label) == ["twice", "twice", "none", "twice", "twice", "none", "twice"]


def test_programme_names_are_plain_text(column):
    for name, hit, miss in (("Miles+More", "my miles+more card", "my milesmore card"),
                            ("Club (X)", "the club (x) lounge", "the club x lounge")):
        rules = airline.rules(name)
        assert column([hit, miss], rules.label) == ["upgrade_loyalty", airline.DEFAULT_INTENT]
