"""Word lists, patterns and domains that decide results.

Everything here is plain data. Every list is a default that the operators take
as a parameter. Term tables of unbounded size (search names, tag aliases) are
not kept here; see ``lexicon`` for how they are loaded or built.
"""

from __future__ import annotations

# --- publication type filter -------------------------------------------------
TYPE_EXCLUDE_PATTERNS = (
    r"\breview\b",
    r"systematic review",
    r"meta-?analysis",
    r"\beditorial\b",
    r"\bcomment\b",
    r"\bletter\b",
    r"published erratum",
    r"retraction of publication",
    r"retracted publication",
)

# --- record cleaner ----------------------------------------------------------
CLEANER_TITLE_PREFIXES = (
    "(invited)",
    "〈",
    "review for",
    "decision letter for",
    "author response for",
    "correction:",
    "retraction:",
    "additions and corrections",
    "editorial:",
    "author correction",
    "review ",
    "a review ",
    "cover feature:",
    "cover picture:",
    "front cover:",
    "frontispiece:",
    "frontispiz:",
    "back cover:",
    "abstract",
    "cheminform abstract:",
    "china & japan:",
    "china:",
    "us:",
    "china's",
    "brazil:",
    "recent",
    "research progress",
    "withdrawn:",
    "retracted",
    "comment",
    "reply",
)
CLEANER_TITLE_PATTERNS = (r"\breview\b", r"\brecent\b", r"\boverview\b")
CLEANER_CONFERENCE_WORDS = ("conference", "mtgabs")
CLEANER_DOI_PATTERNS = (r"\.s00", r"/review", r"/decision", r"/response", r"/pdb")
CLEANER_COVER_PATTERN = r"\(.* \d+/\d{4}\)$"
CLEANER_MIN_TITLE_WORDS = 4

# --- title keyword filter ----------------------------------------------------
TITLE_NEGATIVE_WORDS = (
    "patient",
    "clinical trial",
    "cohort",
    "prognosis",
    "diagnosis",
    "epidemiology",
    "public health",
    "nursing",
    "hospital",
    "systematic review",
    "meta-analysis",
    "economic",
    "social",
    "policy",
    "market",
    "governance",
    "geological",
    "ecological",
    "soil",
    "oceanography",
    "fossil",
    "environmental monitoring",
    "pollution",
    "alloy",
    "ceramic",
    "composite material",
    "semiconductor",
    "quantum",
    "magnetic field",
    "algorithm",
    "software",
)
TITLE_POSITIVE_WORDS = (
    "enzyme",
    "enzymatic",
    "biocatalysis",
    "nanozyme",
    "nanozymes",
    "peroxidase-like",
    "oxidase-like",
    "artificial enzyme",
    "enzyme mimic",
    "microreactor",
    "bioreactor",
    "catalysis",
    "catalytic",
)

# --- title markers and track signals ------------------------------------------
CORE_TERMS = (
    "non-natural amino acid",
    "unnatural amino acid",
    "noncanonical amino acid",
    "non-proteinogenic amino acid",
    "non-standard amino acid",
)
EXTRA_MARKERS = (
    "unnatural amino",
    "non-natural amino",
    "noncanonical amino",
    "non-proteinogenic",
    "non-standard amino",
    "orthogonal aminoacyl",
    "pyrrolysyl-tRNA",
    "amber suppression",
    "ncAA",
)
TRACK_PRIORITY = ("hybrid", "enzymatic", "fermentation", "chemical", "pathway")
KEY_COMPOUNDS = (
    "norvaline",
    "norleucine",
    "tert-leucine",
    "alpha-aminoisobutyric acid",
    "Aib",
    "cyclohexylalanine",
    "4-fluorophenylalanine",
    "fluorophenylalanine",
    "2-naphthylalanine",
    "1-naphthylalanine",
    "naphthylalanine",
    "biphenylalanine",
    "4-hydroxyproline",
    "hydroxyproline",
    "pipecolic acid",
    "citrulline",
    "homoarginine",
    "ornithine",
    "5-hydroxytryptophan",
    "5-fluorotryptophan",
    "fluorotryptophan",
    "azetidine-2-carboxylic acid",
    "difluoroproline",
    "diaminopropionic acid",
    "diaminobutyric acid",
    "homophenylalanine",
    "propargylglycine",
    "allylglycine",
    "phenylglycine",
    "cyclohexylglycine",
    "homoserine",
    "4-pyridylalanine",
    "3-pyridylalanine",
    "2-pyridylalanine",
    "pyridylalanine",
    "4-chlorophenylalanine",
    "chlorophenylalanine",
    "4-cyanophenylalanine",
    "4-methylphenylalanine",
    "4-trifluoromethylphenylalanine",
    "thienylalanine",
    "benzothienylalanine",
    "indanylglycine",
    "cyclopropylalanine",
    "beta-alanine",
    "beta-aminobutyric acid",
    "2-aminocyclohexanecarboxylic acid",
    "homoproline",
    "thiaproline",
    "thiazolidine-4-carboxylic acid",
)
METHOD_SIGNALS = {
    "pathway": (
        "biosynthetic pathway",
        "amino acid biosynthesis",
        "de novo biosynthesis",
        "metabolic pathway engineering",
        "pathway engineering",
        "precursor supply",
        "flux redistribution",
        "transporter engineering",
    ),
    "enzymatic": (
        "enzymatic synthesis",
        "biocatalytic synthesis",
        "biocatalysis",
        "transaminase",
        "aminotransferase",
        "reductive amination",
        "enzyme cascade",
        "multi-enzyme cascade",
        "cell-free protein synthesis",
        "aminoacyl-tRNA synthetase",
        "hydantoinase",
        "carbamoylase",
        "ammonia lyase",
    ),
    "fermentation": (
        "fermentative production",
        "microbial production",
        "microbial synthesis",
        "metabolic engineering amino acid",
        "cell factory amino acid",
        "whole-cell biocatalysis",
        "recombinant strain amino acid",
        "fed-batch fermentation amino acid",
    ),
    "chemical": (
        "asymmetric synthesis",
        "enantioselective synthesis",
        "stereoselective synthesis",
        "total synthesis",
        "chemical synthesis",
        "organocatalysis",
        "phase-transfer catalysis",
        "photoredox catalysis",
        "palladium-catalyzed",
        "chiral auxiliary",
        "Strecker synthesis",
        "dynamic kinetic resolution",
        "kinetic resolution",
        "C-H amination",
    ),
    "hybrid": (
        "chemoenzymatic synthesis",
        "chemoenzymatic preparation",
        "sequential chemoenzymatic",
        "one-pot biocatalysis",
        "enzyme chemical cascade",
        "chemoenzymatic route",
    ),
    "gce": (
        "genetic code expansion",
        "expanded genetic code",
        "amber suppression",
        "stop codon suppression",
        "orthogonal tRNA synthetase",
        "pyrrolysyl-tRNA synthetase",
        "PylRS",
        "MjTyrRS",
        "unnatural amino acid incorporation",
        "noncanonical amino acid incorporation",
        "site-specific incorporation",
        "orthogonal aaRS",
    ),
}
GCE_KEY_COMPOUNDS = (
    "p-azidophenylalanine",
    "p-benzoylphenylalanine",
    "p-acetylphenylalanine",
    "4-azidophenylalanine",
    "4-benzoylphenylalanine",
    "phosphoserine",
    "3-nitrotyrosine",
    "pyrrolysine",
    "azidonorleucine",
    "propargyllysine",
    "trans-cyclooctene lysine",
    "3,4-dihydroxyphenylalanine",
)

# --- search expressions --------------------------------------------------------
GENERIC_TERMS = (
    "non-natural amino acid",
    "unnatural amino acid",
    "noncanonical amino acid",
    "non-proteinogenic amino acid",
)
HYBRID_EXTRA_QUERIES = (
    "chemoenzymatic synthesis amino acid",
    "one-pot chemoenzymatic amino acid",
    "chemoenzymatic asymmetric amino acid synthesis",
)
FREQUENT_COMPOUNDS = (
    "norvaline",
    "norleucine",
    "tert-leucine",
    "Aib",
    "alpha-aminoisobutyric acid",
    "cyclohexylalanine",
    "4-fluorophenylalanine",
    "2-naphthylalanine",
    "1-naphthylalanine",
    "biphenylalanine",
    "4-hydroxyproline",
    "hydroxyproline",
    "pipecolic acid",
    "citrulline",
    "homoarginine",
    "ornithine",
    "5-hydroxytryptophan",
    "5-fluorotryptophan",
    "azetidine-2-carboxylic acid",
    "4,4-difluoroproline",
    "diaminopropionic acid",
    "diaminobutyric acid",
    "homophenylalanine",
    "propargylglycine",
    "allylglycine",
    "phenylglycine",
    "cyclohexylglycine",
    "homoserine",
)
GCE_FREQUENT_COMPOUNDS = (
    "p-azidophenylalanine",
    "p-benzoylphenylalanine",
    "p-acetylphenylalanine",
    "4-azidophenylalanine",
    "4-benzoylphenylalanine",
    "4-acetylphenylalanine",
    "phosphoserine",
    "3-nitrotyrosine",
    "pyrrolysine",
    "azidonorleucine",
    "propargyllysine",
    "trans-cyclooctene lysine",
    "DOPA",
    "3,4-dihydroxyphenylalanine",
)
GENERIC_SEARCH_TERMS = (
    "non-natural amino acid",
    "unnatural amino acid",
    "noncanonical amino acid",
    "non-canonical amino acid",
    "ncAA",
)
SEARCH_SIGNALS = {
    "pathway": (
        "biosynthetic pathway",
        "metabolic pathway",
        "biosynthesis",
        "de novo biosynthesis",
        "pathway engineering",
    ),
    "enzymatic": (
        "enzymatic synthesis",
        "biocatalysis",
        "transaminase",
        "aminotransferase",
        "reductive amination",
        "enzyme cascade",
    ),
    "fermentation": (
        "fermentation",
        "microbial production",
        "metabolic engineering",
        "cell factory",
        "whole-cell biocatalysis",
    ),
    "chemical": (
        "chemical synthesis",
        "asymmetric synthesis",
        "enantioselective synthesis",
        "stereoselective synthesis",
        "total synthesis",
        "organocatalysis",
    ),
    "hybrid": (
        "chemoenzymatic",
        "chemoenzymatic synthesis",
        "sequential biocatalysis",
        "one-pot biocatalysis",
        "enzyme-chemical cascade",
        "chemoenzymatic route",
        "chemo-enzymatic",
    ),
    "gce_method": (
        "genetic code expansion",
        "expanded genetic code",
        "amber suppression",
        "stop codon suppression",
        "orthogonal tRNA",
        "unnatural amino acid incorporation",
        "noncanonical amino acid incorporation",
        "non-canonical amino acid incorporation",
    ),
    "gce_synthetase": (
        "PylRS",
        "MjTyrRS",
        "EcTyrRS",
        "MmPylRS",
        "MbPylRS",
        "pyrrolysyl-tRNA synthetase",
        "orthogonal aminoacyl-tRNA synthetase",
    ),
}
# Term groups searched per track, in order; "frequent" and "generic" are the two
# lists above.
SEARCH_GROUPS = {
    "pathway": (
        "aliphatic", "cyclic", "arginine", "lysine", "aromatic", "proline", "tryptophan", "serine",
        "frequent", "generic",
    ),
    "enzymatic": (
        "aliphatic", "cyclic", "aromatic", "proline", "arginine", "lysine", "tryptophan", "beta",
        "frequent", "generic",
    ),
    "fermentation": (
        "aliphatic", "arginine", "lysine", "aromatic", "proline", "tryptophan", "serine",
        "frequent", "generic",
    ),
    "chemical": (
        "aliphatic", "cyclic", "aromatic", "proline", "arginine", "lysine", "tryptophan", "serine",
        "beta", "frequent", "generic",
    ),
    "hybrid": (
        "aliphatic", "aromatic", "cyclic", "proline", "arginine", "frequent", "generic",
    ),
}
# Single-compound searches of the chemical track: (compound, signal words).
CHEMICAL_SINGLE_SEARCHES = (
    ("4-fluorophenylalanine", ("synthesis", "enantioselective")),
    ("2-naphthylalanine", ("synthesis", "preparation")),
    ("biphenylalanine", ("synthesis",)),
    ("cyclohexylalanine", ("synthesis", "asymmetric")),
    ("tert-leucine", ("synthesis", "resolution")),
    ("norvaline", ("synthesis", "preparation")),
    ("4-hydroxyproline", ("synthesis",)),
    ("pipecolic acid", ("synthesis",)),
)
GCE_SINGLE_SEARCHES = (
    ("p-azidophenylalanine", ()),
    ("p-benzoylphenylalanine", ()),
    ("p-acetylphenylalanine", ()),
    ("pyrrolysine", ()),
    ("phosphoserine", ("protein incorporation", "aaRS", "amber")),
    ("3-nitrotyrosine", ("genetic code", "protein")),
    ("azidonorleucine", ()),
)

# --- screening -----------------------------------------------------------------
CATEGORIES = (
    "pathway", "enzymatic", "fermentation", "chemical", "hybrid", "gce", "both", "unclear", "neither",
)
SYNTHESIS_METHODS = (
    "enzymatic", "fermentation", "chemical", "hybrid", "multiple", "unclear", "none",
)
YES_NO = ("yes", "no", "unclear")
TYPE_LABELS_ZH = {
    "review": "综述",
    "research_article": "研究论文",
    "editorial_comment_letter": "评论/通讯",
    "other": "其他",
}
TYPE_LABEL_DEFAULT = "其他"
RATIONALE_MISSING = "ai_missing_judgment"
RATIONALE_FAILED = "batch_api_error_kept"
RATIONALE_NO_KEY = "skipped_no_api_key"

# --- dates ----------------------------------------------------------------------
MONTH_ABBREVIATIONS = (
    "jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
)
