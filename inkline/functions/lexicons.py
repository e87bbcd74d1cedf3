"""Word and phrase lists of the feature catalogues.

Fixed values: the features are defined over exactly these lists.
"""

# --- lists of the 45-feature catalogue -------------------------------------
STOPWORDS_SHORT = (
    "the", "is", "in", "and", "to", "of", "a", "for", "on", "with", "that", "this", "it",
    "as", "an", "are", "was", "were", "be", "by", "at", "or", "from", "but", "not", "have",
    "has", "had", "they", "their", "them", "he", "she", "his", "her", "you", "your", "we",
    "our", "us", "i", "me", "my", "mine", "yours", "hers", "ours", "theirs",
)
PRONOUNS_LONG = (
    "i", "me", "my", "mine", "you", "your", "yours", "he", "him", "his", "she", "her", "hers",
    "it", "its", "we", "us", "our", "ours", "they", "them", "their", "theirs",
)
FIRST_PERSON = ("i", "me", "my", "mine", "we", "us", "our", "ours")
CONJUNCTIONS = (
    "and", "but", "or", "so", "because", "although", "though", "while", "whereas", "if", "unless",
    "since", "until", "before", "after", "once",
)
TRANSITION_TOKENS = (
    "however", "therefore", "moreover", "furthermore", "thus", "consequently",
    "nevertheless", "meanwhile", "additionally", "instead", "otherwise", "similarly",
    "likewise", "hence",
)
MODALS = ("can", "could", "may", "might", "must", "shall", "should", "will", "would")
BE_VERBS = ("is", "are", "was", "were", "be", "been", "being")
IRREGULAR_PARTICIPLES = (
    "given", "known", "seen", "made", "taken", "done", "written", "built", "found", "used", "created",
)
CONTRACTIONS_ALL = ("n't", "'re", "'ve", "'ll", "'d", "'m", "'s")
COMPLEX_VERBS = (
    "demonstrate", "facilitate", "establish", "indicate", "suggest",
    "highlight", "illustrate", "implement", "optimize", "generate",
    "construct", "analyze", "synthesize", "evaluate",
)
ABSTRACT_SUFFIXES = ("tion", "sion", "ment", "ness", "ity", "ism", "ship", "ance", "ence")
SOPHISTICATED_ADJECTIVES = (
    "significant", "substantial", "comprehensive", "innovative", "efficient",
    "robust", "dynamic", "critical", "essential", "notable", "complex",
    "advanced", "strategic", "systematic", "reliable",
)

# --- lists of the 56-feature catalogue -------------------------------------
HALLMARK_PHRASES = (
    "it is important to note", "plays a crucial role", "it should be noted",
    "furthermore", "moreover", "nevertheless", "consequently", "thus",
    "in conclusion", "to summarize", "in summary", "overall",
    "significantly", "substantially", "considerably", "notably",
    "it is worth noting", "one must consider", "it can be argued",
)
TRANSITION_PHRASES = (
    "however", "therefore", "moreover", "furthermore", "nevertheless",
    "nonetheless", "consequently", "accordingly", "meanwhile",
)
HEDGES = (
    "perhaps", "possibly", "probably", "maybe", "might", "could",
    "would", "should", "seem", "appear", "suggest", "indicate",
)
INTENSIFIERS = (
    "very", "extremely", "highly", "particularly", "especially",
    "remarkably", "incredibly", "absolutely", "completely",
)
CONTRACTIONS_NO_S = ("n't", "'ll", "'ve", "'re", "'m", "'d")
PASSIVE_PHRASES = (
    "is being", "are being", "was being", "were being",
    "has been", "have been", "had been", "will be",
)
DETERMINERS = ("the", "a", "an", "this", "that", "these", "those", "my", "your", "his", "her")
PRONOUNS_SHORT = ("i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us", "them")
THIRD_PERSON = ("he", "she", "it", "they", "him", "her", "them", "his", "hers", "their")
NOUN_SUFFIXES = ("tion", "ment", "ness", "ity")
VERB_SUFFIXES = ("ing", "ed", "ate", "ize")
INFORMAL_WORDS = ("yeah", "yep", "nope", "gonna", "wanna")
INFORMAL_CONTRACTIONS = ("n't", "'ll", "'ve")

# --- common English stop words (default of the vectorisers and of the
#     40-feature catalogue; callers may pass their own) ----------------------
ENGLISH_STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such",
    "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "should", "now", "d", "ll", "m", "o", "re", "ve", "y",
)

# --- small valence lexicon; an input of the sentiment feature, replaceable --
VALENCE = (
    ("good", 1.9), ("great", 3.1), ("best", 3.2), ("happy", 2.7), ("love", 3.2), ("like", 1.5),
    ("nice", 1.8), ("fine", 0.8), ("better", 1.9), ("well", 1.1), ("win", 2.8), ("sure", 1.3),
    ("bad", -2.5), ("worse", -2.1), ("worst", -3.1), ("sad", -2.1), ("hate", -2.7), ("poor", -2.1),
    ("wrong", -2.1), ("fail", -2.5), ("no", -1.2), ("error", -1.8), ("lost", -1.3), ("hard", -0.4),
)
