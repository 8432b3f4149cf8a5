"""Defaults of the engine.

Fixed values: the word lists, markers, patterns and constants below decide what is
extracted, so they are stated as text. Each one is only a default and can be replaced
through ``Profile``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# $, digits with commas, optional fraction, optional unit. Single letters come first
# and nothing bounds the unit, so "$2.5 million" is read as "$2.5 m".
MONEY = r"\$\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:[KMB]|million|billion))?"
# Opt-in form: whole units only.
MONEY_STRICT = r"\$\s*\d[\d,]*(?<!,)(?:\.\d+)?(?:\s*(?:million|billion|[KMB])\b)?"

# category -> label -> whole-word patterns, matched in any case
TOPIC_RULES: dict[str, dict[str, list[str]]] = {
    "research_domains": {
        "Molecular Biology": [r"\bmolecular biology\b", r"\bbiomolecules?\b"],
        "Cellular Biology": [r"\bcellular\b", r"\bcells?\b", r"\bcellular biosciences?\b"],
        "Biophysics": [r"\bbiophysics?\b", r"\bmolecular biophysics\b"],
        "Genetics": [r"\bgenetics?\b", r"\bgenetic\b"],
        "Epigenetics": [r"\bepigenetic[s]?\b"],
        "Synthetic Biology": [r"\bsynthetic biology\b"],
        "Systems Biology": [r"\bsystems biology\b"],
        "Biotechnology": [r"\bbiotechnology\b"],
        "Mathematics": [r"\bmathematics?\b", r"\bmathematical\b"],
        "Computer Science": [
            r"\bcomputer science\b", r"\bcomputing\b", r"\bopen[- ]source\b", r"\bsoftware\b",
        ],
        "Engineering": [r"\bengineering\b"],
        "Physics": [r"\bphysics?\b", r"\bphysical sciences?\b"],
        "Chemistry": [r"\bchemistry\b", r"\bchemical\b"],
        "Quantum": [r"\bquantum\b"],
        "Nanotechnology": [r"\bnanotechnology\b", r"\bnano\b"],
        "Cybersecurity": [r"\bcybersecurity\b", r"\bsecurity\b", r"\bsecure\b"],
        "AI": [r"\bartificial intelligence\b", r"\bai\b"],
        "Machine Learning": [r"\bmachine learning\b", r"\bdeep learning\b"],
    },
    "methods_approaches": {
        "Experimental": [r"\bexperimental\b", r"\bexperiments?\b"],
        "Computational": [r"\bcomputational\b", r"\bcomputation\b"],
        "Theoretical": [r"\btheoretical\b", r"\btheory\b"],
        "Modeling": [r"\bmodeling\b", r"\bmodelling\b", r"\bmodels?\b"],
        "Mechanistic": [r"\bmechanistic\b"],
        "Quantitative": [r"\bquantitative\b"],
        "Predictive": [r"\bpredictive\b"],
        "Integrative": [r"\bintegrative\b"],
        "Data Science": [r"\bdata science\b"],
        "Machine Learning": [r"\bmachine learning\b", r"\bdeep learning\b"],
    },
    "populations": {
        "Underrepresented groups": [
            r"\bunderrepresented\b", r"\bbroaden(ing)? participation\b",
        ],
        "EPSCoR": [r"\bepscor\b"],
        "STEM workforce": [r"\bstem workforce\b"],
        "K-12": [r"\bk-?12\b"],
        "Postdoctoral": [r"\bpostdoc(s)?\b", r"\bpostdoctoral\b"],
        "Graduate students": [r"\bgraduate students?\b"],
        "Undergraduates": [r"\bundergraduates?\b", r"\bundergraduate\b"],
        "Early-career": [r"\bearly[- ]career\b"],
        "Mid-career": [r"\bmid[- ]career\b"],
    },
    "sponsor_themes": {
        "Broadening Participation": [r"\bbroadening participation\b"],
        "Workforce Development": [
            r"\bworkforce\b", r"\btraining\b", r"\bmentoring\b", r"\beducation\b",
        ],
        "Infrastructure": [r"\binfrastructure\b"],
        "Interdisciplinary Research": [
            r"\binterdisciplinary\b", r"\bcross[- ]disciplinary\b",
        ],
        "Basic Research": [r"\bbasic research\b", r"\bfoundational research\b"],
    },
}

# What the bytes 0x80-0x9F mean in numeric references (Windows-1252). The five
# positions without a meaning keep their code point.
CP1252_FROM = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)
CP1252_TO = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


@dataclass(frozen=True)
class Profile:
    """Everything a user can tune; the defaults describe research solicitations."""

    # page text
    hidden_elements: tuple[str, ...] = ("script", "style", "template", "rt", "rp")
    root_elements: tuple[str, ...] = ("main", "body")
    boilerplate: tuple[str, ...] = (
        r"\bSkip to main content\b",
        r"\bNational Science Foundation\b\s+Search",
    )
    # title, identifier, agency, posting date
    title_class: str = "solicitation__title"
    identifier_prefix: str = "NSF"
    agency_phrase: str = "National Science Foundation"
    agency_name: str = "National Science Foundation (NSF)"
    agency_missing: str = "Unknown"
    posted_class: str = "document-info_label"
    posted_label: str = "Posted:"
    # due date
    due_label: str = r"Full Proposal Deadline(?:\(s\))?"
    anytime_phrase: str = "Proposals Accepted Anytime"
    due_window: int = 500
    # description section
    description_starts: tuple[str, ...] = (r"\bII\.\s*Program Description\b\s*:?",)
    description_ends: tuple[str, ...] = (
        r"\bOverall Approach\b",
        r"\bIII\.\s*Award Information\b",
    )
    description_min: int = 40
    # award section
    award_starts: tuple[str, ...] = (r"\bIII\.\s*Award Information\b",)
    award_ends: tuple[str, ...] = (
        r"\bIV\.\s*Eligibility Information\b",
        r"\bIV\.\s*Eligibility\b",
        r"\bV\.\s*Proposal Preparation\b",
    )
    strict_units: bool = False
    # eligibility section
    eligibility_starts: tuple[str, ...] = (
        r"\bIV\.\s*Eligibility Information\b\s*:?",
        r"\bIV\.\s*Eligibility\b\s*:?",
    )
    eligibility_ends: tuple[str, ...] = (
        r"\bV\.\s*Proposal Preparation and Submission Instructions\b",
        r"\bV\.\s*Proposal Preparation\b",
        r"\bVI\.\s*NSF Proposal Processing\b",
        r"\bVI\.\s*Proposal Review Information\b",
    )
    eligibility_label: str = r"Who May Submit Proposals\s*:?\s*"
    eligibility_stops: tuple[str, ...] = (
        "Proposal Preparation and Submission Instructions",
        r"C\.\s*Due Dates",
        "Merit Review Criteria",
        "Award Administration Information",
    )
    eligibility_over: int = 30
    # tags and record
    rules: dict[str, dict[str, list[str]]] = field(default_factory=lambda: TOPIC_RULES)
    parser_source: str = "nsf_html_local"


# page keys
KEY_MAX_LENGTH = 140
KEY_HASH_LENGTH = 10
KEY_EMPTY = "page"

# catalogue columns
CATALOGUE_URL = "Solicitation URL"
CATALOGUE_OPTIONAL = {"title": "Title", "program_id": "Program ID", "nsf_pd_num": "NSF/PD Num"}

DEFAULT_RETRIES = 2
