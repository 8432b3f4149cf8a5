"""A rule table fitted to the given documents, to show rules are a parameter."""

# category -> label -> whole-word patterns; some cannot use snippets and run on the text
WORD_RULES: dict[str, dict[str, list[str]]] = {
    "languages": {
        "English": [r"\bthe\b", r"\bwith\b"],
        "German": [r"\b(?:der|nicht)\b", r"\beine?\b"],
        "Spanish": [r"\bpara\b", r"\blos\b"],
        "French": [r"\bavec\b", r"\baux\b"],
    },
    "words": {
        "Tion": [r"\bt[a-z]*tion\b"],
        "This and that": [r"\bth(is|at)\b"],
        "Ou": [r"\bou[a-z]?\b"],
        "License": [r"\blicen[sc]ed?\b", r"\bcopyright\b"],
    },
}
