"""Word lists. Every operator takes its list as an argument; these are the defaults."""

# Location prepositions, action words and place words used when tagging.
TAG_PREPOSITIONS = (
    "in at near by from around along across beside outside inside behind beneath between "
    "within onto into towards toward off"
).split()
TAG_ACTIONS = (
    "need needs needed send sent require requires required help rescue evacuate evacuated "
    "dispatch deploy bring call request requests requested provide provided save saves saved "
    "assist assists assisted supply supplies supplied get gets urgently emergency trapped "
    "stranded missing injured critical sos mayday airlift relief respond react mobilize"
).split()
TAG_PLACES = (
    "area district region zone sector block ward village town city road bridge river colony "
    "nagar marg lane chowk ghat station coast highway street avenue park island valley "
    "mountain hill beach shore dam camp shelter junction crossing flyover underpass border port"
).split()

# The narrower lists used for token features; scoring leaves out "recover".
FEATURE_PREPOSITIONS = [w for w in TAG_PREPOSITIONS if w not in ("toward", "off")]
FEATURE_ACTIONS = (
    "need send require help rescue evacuate dispatch deploy bring call request provide save "
    "assist supply get airlift mobilize respond relief recover"
).split()
FEATURE_PLACES = [w for w in TAG_PLACES if w != "underpass"]
SCORING_ACTIONS = [w for w in FEATURE_ACTIONS if w != "recover"]

# Parts of speech, dependency labels and fine tags named by the tagging rules.
PLACE_HEAD_POS = ["PROPN", "NOUN", "NUM", "ADJ"]
PLACE_INNER_DEPS = ["compound", "flat", "nmod", "appos", "conj", "pobj"]
PLACE_JOINERS = ["-", "/", "&"]
PLACE_WORD_DEPS = ["pobj", "nsubj", "attr"]
FINITE_TAGS = ["VB", "VBP", "VBZ"]
ACTION_INNER_DEPS = ["dobj", "nsubj", "attr", "advmod", "amod", "compound"]
ACTION_INNER_POS = ["NOUN", "PROPN", "ADJ", "ADV"]
ENTITY_TYPES = ["GPE", "LOC", "FAC", "ORG"]
SCORING_ENTITY_TYPES = ["GPE", "LOC", "FAC"]

# Parts of speech always known to the encoder, span labels and display classes.
SEED_POS = ["X", "NOUN", "PROPN", "VERB", "ADJ", "ADV", "NUM", "PUNCT", "ADP", "DET"]
SPAN_LABELS = ["O", "B-LOC", "I-LOC", "B-ACT", "I-ACT"]
DISPLAY_CLASSES = {"B-LOC": "loc", "I-LOC": "loc", "B-ACT": "act", "I-ACT": "act", "O": "other"}

# Hedging phrases and discourse markers.
HEDGES = [
    "might", "maybe", "perhaps", "possibly", "probably", "seems", "seem", "i think", "i feel",
    "kind of", "sort of", "not sure", "arguably", "likely", "apparently", "presumably", "i guess",
    "somewhat",
]
DISCOURSE = [
    "however", "additionally", "moreover", "furthermore", "therefore", "thus", "meanwhile",
    "nevertheless", "also", "instead", "finally", "first", "second", "overall", "in addition",
    "on the other hand", "for example", "in conclusion", "as a result",
]

# Affixes, tested longest first, list order among equals.
PREFIXES = ["un", "re", "dis", "mis", "pre", "non", "in", "im"]
SUFFIXES = ["ing", "ed", "ly", "ness", "able", "ful", "less", "ment", "tion"]

# Priorities and their codes.
PRIORITY_CODES = {"low": 0, "medium": 1, "high": 2}

# Credential shapes (prefix, least length), placeholders and client-id prefix.
KEY_SHAPES = [("AIza", 35), ("AQ.", 20)]
KEY_PLACEHOLDERS = ["your_gemini_api_key_here", "your_api_key_here"]
CLIENT_ID_PREFIX = "gen-lang-client-"
STOP_TURNS = ["quit", "exit", "bye", "q"]

# Closed classes and a small verb lexicon for the built-in annotator.
ADPOSITIONS = (
    "in at near by from around along across beside outside inside behind beneath between within "
    "onto into towards toward off of on with for to over under about through after before during "
    "without against upon per via"
).split()
DETERMINERS = "the a an this that these those each every some any no all both".split()
PRONOUNS = (
    "i you he she it we they me him her us them my your his its our their mine yours who whom "
    "which what myself yourself itself"
).split()
BE_FORMS = "be is are was were am been being".split()
AUXILIARIES = BE_FORMS + "have has had do does did will would can could shall should may might must".split()
CONJUNCTIONS = "and or but nor so yet".split()
BASE_VERBS = (
    "need send require help rescue evacuate dispatch deploy bring call request provide save assist "
    "supply get airlift mobilize respond react recover trap strand go make take use say see come "
    "give find keep put work know think feel want try ask tell show run rise collapse reach"
).split()
ORG_WORDS = (
    "ndrf army navy police university college company corporation ministry department council "
    "committee team force guard brigade hospital institute"
).split()
STOPWORDS = sorted(set(ADPOSITIONS + DETERMINERS + PRONOUNS + AUXILIARIES + CONJUNCTIONS + ["not", "as", "than"]))


def verb_forms(bases: list[str] = BASE_VERBS) -> list[str]:
    """Regular third-person forms of the base verbs; -ing and -ed are recognised by suffix."""
    third = [b[:-1] + "ies" if b.endswith("y") else b + ("es" if b.endswith("ch") else "s") for b in bases]
    return bases + third + ["sent", "brought", "got", "gone", "made", "took", "said", "saw", "came", "gave", "ran"]
