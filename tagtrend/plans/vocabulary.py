"""Dictionaries, rules, templates and patterns for the catalogue's tables. All of them are parameters of
operators; none is known to an operator."""

from __future__ import annotations

PART_KEYWORDS = {
    "temperature": ["hot", "cold"],
    "colour": ["red", "blue"],
    "size": ["small", "large"],
    "age": ["old", "new"],
    "item": ["ring", "widget", "bolt", "gear", "gizmo", "plate", "anvil", "rod"],
}
PART_LIST = [k for words in PART_KEYWORDS.values() for k in words]

DOCUMENT_KEYWORDS = {
    "english": ["the", "with", "that", "tion", "ing"],
    "german": ["und", "nicht", "keit", "sch", "ung"],
    "french": ["les", "que", "eau", "ment", "eux"],
    "spanish": ["los", "para", "ción", "ado", "ente"],
}
DOCUMENT_LIST = [k for words in DOCUMENT_KEYWORDS.values() for k in words]

# Ordered: the first rule with a hit decides.
TOPIC_RULES = {
    "ECONOMY": ["keit", "lich ", "ungs"],
    "LARGE": ["eaux", "ment ", "ière"],
    "MEDIUM": ["ción", "ados", "ente "],
    "PROMO": ["blest", "thing", "rewh"],
    "SMALL": ["than ", "ering"],
    "STANDARD": ["tion", "with", "que"],
}
INTENT_RULES = {
    "study": ["the ", "der ", "les ", "los "],
    "timing": ["that", "wh", "von ", "quand"],
    "trend": ["this", "neu", "nou", "nue"],
    "size": ["was", "groß", "gran", "large"],
}
PRIORITY_RULES = {"rush": ["urgent", "high"], "normal": ["medium", "specified"]}
SCALE_RULES = {"big": ["LARGE", "STANDARD"], "public": ["PROMO", "MED"]}

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PERIODS = {"first": ("1998-01", "1998-12"), "second": ("1999-01", "1999-12"), "recent_from": "2000-01"}
MONTHS = ("1998-01", "1999-12")  # the period of the monthly counts
SEGMENTS = ("BUILDING", "MACHINERY")
CLUSTER_LINKS = [("ECONOMY", 0), ("LARGE", 1), ("MEDIUM", 2), ("MEDIUM", 3), ("PROMO", 4), ("PROMO", 5), ("SMALL", 6), ("STANDARD", 7), ("STANDARD", 8)]

CHAT_MARKERS = {
    "begin": "<|begin_of_text|>",
    "header_start": "<|start_header_id|>",
    "header_end": "<|end_header_id|>\n\n",
    "turn_end": "<|eot_id|>\n",
    "end": "<|end_of_text|>",
}
SYSTEM_TEXT = "You advise on learning plans from counted market data."

CROSS_TEMPLATES = [
    "In which order should I learn for {category} work in {segment}?",
    "Which skills does {segment} ask for in {category}?",
    "I start from zero: plan my way to {category} in {segment}.",
    "What matters most for {category} at a {segment} firm?",
]
ROTATING_TEMPLATES = [
    "Requirements of a {source} text in {lang}:\n{req}\nHow do I prepare?",
    "I read this {source} text ({lang}). What first?\n{req}",
    "Rank the topics of this {lang} text from {source}.\n{req}",
    "Half a year for this {source} text in {lang}: what now?\n{req}",
]
CHOICE_TEMPLATES = [
    "Which item and which colour does {segment} ask for most?",
    "What should I learn first for {segment}?",
    "What do {segment} records have in common?",
]
COMPARE_TEMPLATES = [
    "How do the two segments differ?",
    "As a {job} person, which segment first?",
    "Do the stacks differ much?",
    "Moving from one to the other, what must a {job} person add?",
]
RECORD_TEMPLATES = [
    "What does this {lang} text from {source} ask for?\n{duties}",
    "Is this {source} text a good start?\n{duties}",
    "Sum up the {lang} text from {source}.\n{duties}",
]
MAX_WORDS = 1024
COMPARE_JOBS = ["ring", "bolt", "gear", "rod"]

PROMPT = (
    "Background: {experience}.\nGoal: {company} {job} within {period}.\nKnown: {stack}\n"
    'Answer only with JSON like {"title": "...", "total_weeks": 0, "steps": []}.'
)
PLAN_TEMPLATES = {
    "BUILDING": [("Ground", ["Survey (tape)", "Sketch"]), ("Frame", ["Timber (spruce)", "Steel", "Bolts"]), ("Roof", ["Tiles"])],
    "MACHINERY": [("Parts", ["Gear (spur)", "Rod"]), ("Assembly", ["Bolts", "Gear (helical)", "Oil", "Belt"]), ("Tuning", ["Gauge", "Oil"]), ("Service", ["Log (paper)"])],
    "FURNITURE": [("Wood", ["Oak", "Timber (beech)"]), ("Joints", ["Dowel", "Glue (bone)"])],
}
PLAN_WEEKS = {"short": 12, "medium": 24, "long": 48}
PLAN_RESOURCES = {
    "Gear": ["Gear handbook", "Gear course"],
    "Timber": ["Timber guide", "Steel guide"],
    "Steel": ["Steel guide"],
    "Bolts": ["Bolt tables"],
    "Oil": ["Oil primer", "Gauge notes", "Oil labs"],
}
PLAN_TEXTS = {
    "title": "{job} plan over a {period} term ({company})",
    "summary": "{company}: {job} in a {period} term",
    "duration": "{weeks} weeks",
    "description": "Stage {title} trains {techs}.",
    "milestone": "One small {tech} project",
    "portfolio_tip": "Record each stage and why each tool was chosen.",
}
PLAN_INSIGHTS = {"1": "Small firms want people who can start at once.", "2": "Mid-size firms want breadth."}
PLAN_DEFAULT_INSIGHT = "Large firms test foundations."
STEP_PATTERN = "step {step} [{title}] - {techs} ({duration})"

ANSWER_FORMATS = {
    "keyword_rate": "{keyword}({rate}%)",
    "study": "## {topic}: required keywords\nCore: {core}\nPlus: {plus}",
    "clusters": "## Types found by clustering\n{lines}",
    "cluster": "[type {number}] {name} ({n} records): {tokens}; {size}",
    "timing": "## When to apply: {topic}\nPeak {peak} ({n} records, monthly mean {mean}, {uplift}), prepare from {prep}",
    "timing_line": "- {topic}: {peak} ({n}, {uplift}), prepare from {prep}",
    "timing_all": "## When to apply\n{lines}",
    "rising_line": "- {keyword}: {first} -> {second} ({growth})",
    "falling_line": "- {keyword} {growth}",
    "rising": "Rising now:\n{lines}",
    "trend": "## Trends\nRising:\n{rising}\nFalling:\n{falling}",
    "size": "## Segment differences\n{a}: {a_list}\n{b}: {b_list}",
    "sample": "{i}. {title} - {company}",
    "sample_tags": " [{tags}]",
    "samples": "---\nRelated records:\n{lines}",
    "overview": "## Overview\nMost common: {top}",
}
ANSWER_FOOTER = "---\nSource: all records of the period."

#: A term of the documents' languages in lower case, as every engine's regular expressions read it.
TERM_PATTERN = "[a-zß-öø-ÿ]+"
