"""The airline support pack: taxonomy, rules, red flags, quotas and reply templates.

The name of the loyalty programme is an input, as brands differ in nothing else here.
"""

from __future__ import annotations

import re

from replylane.functions.decision import EscalationPolicy
from replylane.functions.rules import FlagSet, RuleSet

# Every constant down to the templates has to be what it is for labels,
# decisions, sample sizes and drafts to come out right.
INTENTS = (
    "flight_disruption", "baggage_issue", "booking_checkin_issue",
    "refund_compensation_request", "upgrade_loyalty", "service_complaint",
    "info_question", "praise_thanks", "other_unclear",
)

DEFAULT_INTENT = "other_unclear"

REFUND = (
    r"\brefund\b", r"\breimburs", r"\bcompensat", r"\bwaive[d]?\b",
    r"\b(fee|charge)s?\s+(back|refunded|waived)\b", r"\bcredit\s+(back|voucher)\b",
    r"\bmoney\s+back\b", r"\bchange\s+fees?\b", r"\bextra\s+fee\b",
    r"\bwhy\s+.{0,15}charged\b",
)
BAGGAGE = (
    r"\bbag(s|gage)?\b.{0,25}\b(lost|missing|delayed|damaged|late|no\s)",
    r"\bno\s+bags?\b", r"\bgate.?check", r"\bcarry.?on\b", r"\bsuitcase\b",
    r"\blost\s+(my\s+)?bag", r"\bbaggage\s+claim\b",
)
DISRUPTION = (
    r"\bdelay(ed|s)?\b", r"\bcancel(led|lation)?\b", r"\bmissed?\s+(my\s+)?connection",
    r"\bdiverted?\b", r"\bstuck\s+(on\s+the\s+)?(plane|tarmac|gate)\b",
    r"\bno\s+(pilot|plane|crew)\b", r"\bgrounded\b", r"\brebook(ing)?\b",
    r"\banother\s+(hour|flight)\b", r"\b(held|waiting|sitting)\b.{0,20}\btarmac\b",
    r"\bgate\s+chang",
)
BOOKING = (
    r"\bcheck.?in\b", r"\bboarding\s+pass\b", r"\bseat\s+assignment\b",
    r"\bcan.?t\s+book\b", r"\breservation\b", r"\bbook(ing)?\s+(a\s+)?(flight|ticket)\b",
    r"\bwon.?t\s+recline\b", r"\bwrong\s+terminal\b", r"\bapp\s+(won.?t|isn.?t|not)\b",
)
LOYALTY = (
    r"\bupgrade\b", r"\b{loyalty_program}\b",
    r"\b(ep|gold|platinum|executive)\s+(status|member)\b", r"\bmiles\b",
    r"\bfirst\s+class\b.{0,20}\b(upgrade|available)\b", r"\belite\s+status\b",
)
PRAISE = (
    r"\bthank(s| you)\b", r"\bkudos\b", r"\bshout.?out\b", r"\bappreciate\b",
    r"\b(amazing|wonderful|great|awesome|lovely|fantastic)\s+"
    r"(service|crew|flight|staff|attendant)\b",
    r"^thanks?\b", r"\bwell\s+done\b",
)
COMPLAINT = (
    r"\bworst\s+(customer\s+service|airline|experience)\b", r"\brude\b", r"\bdisgust",
    r"\bunacceptable\b", r"\bdiscriminat", r"\bno\s+remorse\b", r"\bhorrible\b",
    r"\bterrible\s+(service|experience)\b", r"f+u+c*k", r"\bnever\s+fly(ing)?\s+again\b",
    r"\blet\s+down\b", r"\bget\s+it\s+together\b", r"\bsuck(s)?\b", r"\bridiculous\b",
    r"\bpathetic\b", r"\bunethical\b", r"\bawful\b", r"\bshame\s+on\s+you\b",
    r"\bdisappoint(ed|ing)?\b", r"\bshould(n.?t)?\s+have\s+to\b",
)
QUESTION = (
    r"\?\s*$", r"\bany\s+(idea|chance|way)\b", r"\bhow\s+(do|can|long)\b",
    r"\bwhat\s+(time|gate|terminal)\b", r"\bis\s+there\b", r"\bcan\s+i\b",
    r"\bwill\s+(i|we)\b",
)

PRIORITY = (
    ("refund_compensation_request", REFUND),
    ("baggage_issue", BAGGAGE),
    ("flight_disruption", DISRUPTION),
    ("booking_checkin_issue", BOOKING),
    ("upgrade_loyalty", LOYALTY),
    ("praise_thanks", PRAISE),
    ("service_complaint", COMPLAINT),
    ("info_question", QUESTION),
)

FLAGS = (
    ("safety_or_medical", r"\b(medical|emergency|security|weapon|gun|unsafe|airworth)\w*\b"),
    ("discrimination_or_legal",
     r"\b(discriminat\w*|lawyer|legal action|sue|lawsuit|threat(en)?)\b"),
    ("repeated_failure",
     r"\b(again|3rd time|third time|multiple times|every time|every single)\b"),
    ("premium_customer_risk",
     r"\b(platinum|executive platinum|concierge key|elite|gold status"
     r"|\d+\s*(year|yr)s?\s+(loyal|flying|member))\b"),
    ("strong_anger",
     r"f+u+c*k|\bworst\b.{0,20}\b(ever|airline|service)\b|\bunacceptable\b|\bdisgust"),
    ("explicit_compensation_or_refund",
     r"\brefund\b|\bcompensat\w*|\breimburs\w*|\bvoucher\b"),
    ("account_specific_dispute",
     r"\bupgrade list\b|\bmiles\b.{0,15}\b(wrong|missing|not credited)\b|\bpnr\b"),
)

ESCALATE_BY_DEFAULT = ("service_complaint", "refund_compensation_request")
LOW_RISK = ("praise_thanks",)
MIN_CONFIDENCE = 0.45

MIN_CUSTOMER_LENGTH = 8
MIN_REPLY_LENGTH = 25

QUOTAS = {
    "flight_disruption": 25, "baggage_issue": 22, "booking_checkin_issue": 22,
    "refund_compensation_request": 22, "upgrade_loyalty": 20, "service_complaint": 22,
    "info_question": 22, "praise_thanks": 20, "other_unclear": 20,
}

TEMPLATES = {
    "flight_disruption":
        "We're sorry for the disruption to your flight, {name}. {retrieved_hint} "
        "We'll keep you posted on any updates.",
    "baggage_issue":
        "We're sorry about your baggage, {name}. {retrieved_hint} "
        "Please share your bag tag / claim number via DM so we can trace it.",
    "booking_checkin_issue":
        "Sorry for the trouble checking in, {name}. {retrieved_hint} "
        "Please DM your confirmation number and we'll help sort it out.",
    "refund_compensation_request":
        "Thanks for reaching out about this, {name}. {retrieved_hint} "
        "Please DM your confirmation number so our team can review your "
        "refund/compensation request.",
    "upgrade_loyalty":
        "Thanks for the question, {name}. {retrieved_hint} "
        "Please DM your {loyalty_program} number so we can look into your account.",
    "service_complaint":
        "We're sorry to hear about this experience, {name}. {retrieved_hint} "
        "We'd like to look into this further -- please DM us the flight details.",
    "info_question": "Thanks for reaching out, {name}. {retrieved_hint}",
    "praise_thanks":
        "Thank you so much for the kind words, {name}! "
        "We'll be sure to pass this along to the team.",
    "other_unclear":
        "Thanks for reaching out, {name}. "
        "Could you share a bit more detail (flight number, dates) so we can help?",
}
# End of the fixed values.


def rules(loyalty_program: str) -> RuleSet:
    """The rules with the programme's name as plain text; a boundary only beside word characters."""
    name = loyalty_program.lower()
    before = r"\b" if re.match(r"\w", name) else ""
    after = r"\b" if re.search(r"\w$", name) else ""
    literal = before + "".join(re.escape(c) if c.isascii() else c for c in name) + after
    named = tuple(
        (label, tuple(p.replace(r"\b{loyalty_program}\b", literal) for p in patterns))
        for label, patterns in PRIORITY
    )
    return RuleSet(named, DEFAULT_INTENT)


def policy() -> EscalationPolicy:
    return EscalationPolicy(FlagSet(FLAGS), ESCALATE_BY_DEFAULT, LOW_RISK, MIN_CONFIDENCE)


def templates(loyalty_program: str) -> dict[str, str]:
    return {k: t.replace("{loyalty_program}", loyalty_program) for k, t in TEMPLATES.items()}
