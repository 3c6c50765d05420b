"""Words that count as nothing, per use; the sets differ on purpose and must not be unified."""

from __future__ import annotations

# Fixed values.
KG_EMPTY = ("", "none", "null", "not specified")
SYMBOL_EMPTY = (*KG_EMPTY, "unknown", "n/a")
ENRICHMENT_EMPTY = (*KG_EMPTY, "not reported", "unknown")
MERGE_EMPTY = ("", "null", "not reported")
UNREPORTED = ("", "n/a", "na", "null", "none", "not reported", "not available", "not determined", "nd", "n.d.")
TARGET_PLACEHOLDERS = ("none", "null", "n/a", "na", "/", "not specified", "not reported", "trace", "determined by chiral hplc")
FILTER_NAME_EMPTY = ("", "none", "null", "unknown", "not specified", "<invalid>")
CONDITION_EMPTY = ("", "not specified", "null", "n/a")
REACTION_TYPE_EMPTY = ("", "null", "none", "n/a", "not specified")
METRIC_EMPTY = ("", "null", "none", "not reported", "not specified", "n/a", "na")
GENERIC_NAMES = ("compound", "substrate", "product", "reagent", "ligand", "catalyst", "additive", "base", "unknown")
UNCERTAIN = ("maybe wrong", "please check", "not sure", "uncertain")
UNKNOWN_REACTION = "unknown reaction"
INVALID_NAMES = (
    "target product",
    "desired product",
    "white product",
    "not specified",
    "colorless oil",
    "product",
    "starting material",
    "compound",
    "material",
    "mixture",
    "oil",
    "solid",
    "liquid",
    "crude",
)
QUANTITATIVE_WORDS = ("yield", " enantiomeric", " ee ", " er ", " dr ", " mmol", " equiv", " conv", "diastereomeric")
CHEMISTRY_WORDS = (
    "reaction",
    "substrate",
    "product",
    "catalyst",
    "solvent",
    "table",
    "entry",
    "scheme",
    "optimization",
    "general procedure",
    "coupling",
    "cross-coupling",
    "suzuki",
    "miyaura",
    "heck",
    "sonogashira",
    "buchwald",
    "ullmann",
    "negishi",
    "stille",
    "boronic",
    "boronate",
    "aryl halide",
    "palladium",
    "pd",
    "biaryl",
    "base",
    "reduction",
    "oxidation",
    "hydrogenation",
    "amination",
    "amidation",
    "esterification",
    "cyclization",
    "annulation",
    "cycloaddition",
    "enantioselective",
    "stereoselectiv",
    "diastereoselectiv",
    "regioselectiv",
    "asymmetric",
    "chiral",
    "enantiomer",
    "photocatal",
    "irradiation",
    "wavelength",
    "sensitiz",
    "photocycloaddition",
    "triplet",
    "radical",
    "dearomat",
    "pericyclic",
)
PAGE_THRESHOLD = 3
# names of products that don't tell what they are
VAGUE_PRODUCTS = ("unknown product", "heterodimer")
NUMBERED_PRODUCT = r"\A(product|compound|adduct)\s*\w+\z"
SHORT_LABEL = r"\A\w{1,3}\z"
LOOKS_OF_PRODUCT = r"\b(solid|oil|liquid|foam|powder|crystal|residue)\b"
MODALITIES = {"text": "text", "textual": "text", "image": "image", "chemeagle": "image", "vision": "image"}
DIRECT_ROLES = {"light source": "light", "precatalyst": "catalyst", "catalysts": "catalyst", "additives": "additive"}
REFINED_ROLES = ("catalyst", "ligand", "additive", "base", "reagent", "solvent", "temperature", "time", "concentration", "volume", "atmosphere", "yield", "ee", "er", "dr", "unknown")
KEPT_ROLES = (
    "solvent",
    "temperature",
    "time",
    "concentration",
    "volume",
    "atmosphere",
    "light",
    "light source",
    "wavelength",
    "catalyst",
    "catalysts",
    "ligand",
    "precatalyst",
    "base",
    "additive",
    "additives",
    "yield",
    "ee",
    "er",
    "dr",
)
CONDITION_LABELS = {"temperature": "temp", "time": "time", "concentration": "conc", "atmosphere": "atm", "light source": "light", "light_source": "light", "wavelength": "wl"}
AMOUNT_COLUMNS = {
    "USES_SUBSTRATE": "substrate_amount",
    "PRODUCES": "product_amount",
    "USES_CATALYST": "catalyst_amount",
    "USES_LIGAND": "ligand_amount",
    "USES_SOLVENT": "solvent_amount",
    "USES_OTHER_COMPONENT": "other_component_amount",
    "USES_ADDITIVE": "additive_amount",
    "USES_REAGENT": "reagent_amount",
}
IGNORED_RELATIONS = ("REPORTED_IN", "OF_TYPE", "HAS_SCAFFOLD", "HAS_SUBSTITUENT", "EXTRACTED_FROM_IMAGE", "SAME_AS", "NAME_RESOLVED_BY")
EDGE_COLUMNS = (
    "x_name",
    "x_type",
    "relationship",
    "y_name",
    "y_type",
    "pdf_name",
    "reaction_id",
    "source_pages",
    "step",
    "substrate_amount",
    "product_amount",
    "catalyst_amount",
    "ligand_amount",
    "solvent_amount",
    "other_component_amount",
    "additive_amount",
    "reagent_amount",
    "yield",
    "ee",
    "er",
    "dr",
    "source_modality",
    "source_image",
)
TERMINAL_ROLE = "reagent"
SOLVENT_NAME_LABELS = ("solvent",)
SOLVENT_LABELS = ("solvent", "solvent amount", "vol", "volume")
OBVIOUS_GENERIC = (
    "ketone derivative",
    "aldehyde derivative",
    "amine derivative",
    "acid derivative",
    "alcohol derivative",
    "ester derivative",
    "amide derivative",
    "nitrile derivative",
    "olefin derivative",
    "alkene derivative",
    "alkyne derivative",
    "vinyl derivative",
    "aryl derivative",
    "heteroaryl derivative",
    "phenol derivative",
    "compound",
    "product",
    "material",
    "starting material",
    "unknown",
    "not specified",
    "not reported",
    "n/a",
    "null",
)
GENERIC_PARTS = ("derivative", "substituted", "compound", "starting material", "product", "material", "mixture")
# name -> pattern of text in which a formula lost its subscripts
BROKEN_FORMULAS = {
    "alkali_carbonate_gap": r"\b(?:Na|K|Li)\s+CO\b",
    "alkali_sulfate_gap": r"\b(?:Na|K|Li)\s+SO\b",
    "magnesium_sulfate_missing_subscript": r"\bMgSO(?=\s*(?:[,.;)]|$)|\s+(?:and|was|were|filtered|dried)\b)",
    "bicarbonate_missing_subscript": r"\b(?:Na|K)HCO(?=\s*(?:[,.;)]|$)|\s+(?:solution|was|were)\b)",
    "nickel_chloride_missing_subscript": r"\bNiCl\s*(?=[(\[])",
    "chlorinated_solvent_gap": r"\b(?:CH|CD)\s+Cl\b",
    "deuterated_chloroform_missing_subscript": r"\bCDCl(?=\s*(?:[,.;:)]|$))",
    "ether_gap": r"\bEt\s+O\b",
}
ANALYTICAL_PAGE = r"(?i)(?:NMR\s+Spectra|NOE\s+spectrum|UPC2\s+traces|HPLC\s+traces|Crystal\s+Structure|Crystal\s+data|Crystal\s+structure\s+determination|CCDC\s+\d+|diffractometer)"
ELEMENTS = tuple(
    "H D He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe"
    " Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db"
    " Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og".split()
)
USD_PER_MILLION_TOKENS = {"gpt-4o": (2.50, 10.00), "gpt-5-mini": (0.25, 2.00)}
# Words by which a text defines a general procedure, and by which it refers to one.
PROCEDURE_DEFINITIONS = (
    "charged with",
    "was added",
    "flask",
    "dissolved",
    "stirred",
    "irradiated",
    "heated",
    "cooled",
    "degassed",
    "sealed",
    "mixture",
    "solution",
    "suspension",
    "reaction mixture",
    "inert atmosphere",
    "under n2",
    "round-bottom",
)
PROCEDURE_REFERENCES = ("according to", "prepared according", "using ", "following the", "following procedure", "following procedures", "as described", "following general")
