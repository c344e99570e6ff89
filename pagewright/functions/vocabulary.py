"""Fixed values that results depend on: headings, keywords, glyphs and patterns of the document template."""

from __future__ import annotations

# Section headings.
SECTION_VOCAB = [
    "overview", "coverage policy", "references", "revision details",
    "coding information", "general information", "background",
    "appendix", "definitions", "instructions for use",
    "medical necessity criteria", "reauthorization criteria",
    "authorization duration", "conditions not covered",
    "product criteria", "other uses with supportive evidence",
    "disease overview", "guidelines", "safety", "recommendations",
]

# Section headings of the medical and administrative families.
MM_SECTION_VOCAB = [
    "overview", "coverage policy", "references", "revision details",
    "coding information", "general information", "background",
    "appendix", "definitions", "instructions for use",
    "medical necessity criteria", "reauthorization criteria",
    "authorization duration",
    "general background",
    "health equity considerations",
    "medicare coverage determinations",
    "scope", "procedure", "standard procedure",
    "attachments", "compliance measure",
    "state/federal guidelines", "state/federal compliance",
]

# Subsection headings.
SUBSECTION_VOCAB = [
    "policy statement", "drug quantity limits", "general information",
    "notes", "medically necessary", "not medically necessary",
    "experimental", "investigational",
    "considered medically necessary", "considered not medically necessary",
    "dosing", "availability", "dose escalation", "criteria", "indications",
    "fda-approved indications", "fda-approved indication",
    "compendium indications", "off-label use", "place in therapy",
    "background", "contraindications", "warnings", "guidelines",
    "other uses with supportive evidence", "guidelines/scientific statements",
    "clinical evidence", "monitoring", "administration",
    "coverage criteria", "authorization criteria", "quantity limits",
    "reauthorization criteria", "authorization duration",
    "medical necessity criteria",
]

# Headings that the corpus profile counts.
CORPUS_HEADINGS = [
    "coverage policy", "references", "revision details",
    "coding information", "overview", "general information",
    "background", "appendix", "definitions", "instructions for use",
    "conditions not covered", "product criteria", "guidelines",
    "other uses with supportive evidence", "disease overview",
    "safety", "recommendations", "medical necessity criteria",
    "health equity considerations", "general background",
    "medicare coverage determinations", "scope", "procedure",
    "standard procedure", "attachments", "compliance measure",
    "state/federal guidelines", "state/federal compliance",
]

# Fragments of boilerplate text; {publisher} is the publisher's name in lower case, a parameter.
BOILERPLATE_FRAGMENTS = [
    "instructions for use",
    "confidential, unpublished property of {publisher}",
    "do not duplicate or distribute",
    "use and distribution limited solely",
    "© copyright {publisher}",
    "{publisher} coverage policies",
    "individual coverage determinations",
    "this coverage policy is subject to",
    "reserved for {publisher}",
    "{publisher} does not endorse",
]

# Page footers.
FOOTER_PATTERNS = [r"(?i)^Page\s+\d+\s+of\s+\d+", r"(?i)^Coverage\s+Policy\s+Number\s*:"]
FOOTER_TOP = 715

# Bullet glyphs.
BULLET_CHARS = ["\u2022", "\u25cf", "\u25cb", "\u25e6", "\u2023", "\uf0b7", "\uf0a7"]

# Words written in capitals in headings.
ACRONYMS = ["fda", "iv", "sc", "dvt", "pe", "vte", "hae", "gi", "nccn", "aca", "acc", "aha", "nla", "tg", "pa", "nms"]

# Keywords of table headers and titles.
KNOWN_KW = ["Compound Name", "Drug Name", "Comments", "Prescribing Information", "Ingredient"]
TITLED_GENERIC_KW = [
    "preferred and non-preferred", "preferred products", "by indication",
    "drug availability", "dosage forms", "fda approved", "fda recommended",
    "simon broome", "dutch lipid", "laboratory diagnosis",
    "diagnostic criteria", "reauthorization criteria", "dose conversion",
    "dosing regimen", "indications", "individual and family plans",
    "employer plans", "fda approved indication", "fda recommended dosing",
    "fda approved products",
]
TITLED_GENERIC_EXACT = ["dosing", "drug availability", "dosage forms for this indication", "follistim pen dose conversion table*"]
DETECTOR_TITLE_KW = [
    "preferred and non-preferred products", "preferred products", "non-preferred products",
    "by indication", "drug availability", "dosage forms", "fda approved", "fda recommended",
    "appendix", "prescription drug lists", "simon broome", "dutch lipid", "laboratory diagnosis",
    "diagnostic criteria", "reauthorization criteria", "dose conversion", "dosing regimen",
    "indications", "individual and family plans", "employer plans", "fda approved indication",
    "fda recommended dosing", "fda approved products",
]
PROSE_HEADER_STARTS = [
    "Type of", "Summary", "Date", "Product", "Strength", "HCPCS", "CPT", "ICD", "Retail", "Dosage",
    "Agent", "Medication", "Condition", "Brand", "Drug",
]
DQL_KW = ["strength", "retail", "home", "delivery", "maximum", "quantity", "limit", "days", "supply"]

# Order of the families in a batch.
PREFIX_ORDER = ["dqm", "ip", "p", "ph", "psm", "st"]

# Starts of italic lines that are no headings.
ITALIC_BOILERPLATE = [
    "the following", "policies are", "certain {publisher}",
    "evidence of", "coverage policies", "reimbursement",
    "when billing", "authorization", "please note",
    "service agreement", "companies and",
]

# Sections of the medical families with second-level headings.
LEVEL_2_SECTIONS = [
    "general background", "coverage policy",
    "coding information", "health equity considerations",
    "medicare coverage determinations",
]


def proper_case(entry: str) -> str:
    """A vocabulary entry as a heading: words and hyphenated parts capitalised, acronyms in capitals."""
    part = lambda p: p.upper() if p.lower() in ACRONYMS else p.capitalize()
    return "/".join(" ".join("-".join(map(part, word.split("-"))) for word in piece.split()) for piece in entry.split("/"))
