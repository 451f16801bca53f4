"""Fixed values. Results depend on these exact strings and numbers; they are data, not logic."""

# --- Fixed values: labels that name no function (case-insensitive, searched anywhere) -----
UNINFORMATIVE_ALTERNATIVES = (
    r"hypothetical",
    r"uncharacteri[sz]ed",
    r"(?<![a-z])(?:DUF|UPF)\d*(?![a-z])",
    r"unknown function",
    r"unnamed protein",
    r"(?:^|^\S*\d\S*\s+|:\s*|Full=)(?:putative|predicted|conserved) protein\s*(?:$|;|\[)",
)
UNINFORMATIVE = "(?i)" + "|".join(UNINFORMATIVE_ALTERNATIVES)

# --- Fixed values: names that describe a domain, not the protein --------------------------
DOMAIN_NAMED = r"(?i)domain[- ]containing protein|\bfamily protein\b"

# --- Fixed values: rungs of the dark evidence ladder, strongest first ---------------------
RUNG_CURATED = r"(?i)(?<![a-z])(?:DUF|UPF)\d*(?![a-z])"
RUNG_CONSERVED = r"(?i)\bconserved\b"
RUNGS = ("CURATED_FAMILY", "CONSERVED", "PREDICTED_ONLY", "NONE")

# --- Fixed values: closed topologies and the longest appended copy ------------------------
CIRCULAR_TOPOLOGIES = ("circular", "direct terminal repeat")
MAX_OVERLAP_BP = 5000

# --- Fixed values: status words -----------------------------------------------------------
NOT_RUN = "NOT_RUN"
NO_HIT = "NO_HIT"
TOO_FEW_LINEAGES = "TOO_FEW_LINEAGES"
NO_CONTEXT = "NO_CONTEXT"
SUCCESS = "SUCCESS"
NOT_MEASURED = "NOT_MEASURED"

# --- Fixed values: identity tiers (percent identity, percent coverage of both) ------------
TIER1_IDENTITY, TIER1_COVERAGE = 80.0, 90.0
TIER2_IDENTITY, TIER2_COVERAGE = 60.0, 70.0

# --- Fixed values: label kind per label database ------------------------------------------
LABEL_KIND = {
    "card": "card_amr_family",
    "amrfinder": "amrfinder_gene",
    "tadb": "tadb_ta",
    "bacmet": "bacmet_compound",
    "oritdb": "oritdb_role",
    "mobileog": "mobileog_category",
    "dbapis": "dbapis_family",
    "acrdb": "acrdb_family",
}
TIERED_SOURCES = ("tadb", "bacmet", "oritdb", "mobileog", "dbapis", "acrdb")

# --- Fixed values: database name per label database ---------------------------------------
LABEL_DATABASE = {
    "tadb": "TADB",
    "bacmet": "BacMet",
    "oritdb": "oriTDB",
    "card": "CARD protein homolog models",
    "mobileog": "mobileOG-db",
    "dbapis": "dbAPIS",
    "acrdb": "Anti-CRISPRdb",
    "amrfinder": "AMRFinderPlus database",
}

# --- Fixed values: every label kind admitted beside the label databases' own --------------
HIT_KINDS = (
    "pfam_family", "pfam_description", "pfam_clan",
    "swissprot_product", "nr_product",
    "pharokka_annotation", "pharokka_category",
    "card_gene_family", "card_mechanism", "vfdb_factor",
    "gene_symbol", "cog_category", "cog_id", "eggnog_pfam", "eggnog_description",
    "go", "ec", "kegg_ko",
)
KINDS = HIT_KINDS + tuple(LABEL_KIND.values())
HIT_SOURCES = ("pfam", "pharokka", "card", "vfdb", "swissprot", "nr")

# --- Fixed values: (type, subtype) pairs an AMR element may carry -------------------------
ELEMENT_TYPES = (
    ("AMR", "AMR"), ("AMR", "POINT"),
    ("STRESS", "METAL"), ("STRESS", "BIOCIDE"), ("STRESS", "ACID"), ("STRESS", "HEAT"),
    ("VIRULENCE", "VIRULENCE"), ("VIRULENCE", "ANTIGEN"),
)

# --- Fixed values: context term prefix per label kind -------------------------------------
TERM_PREFIX = {
    "card_amr_family": "amr",
    "tadb_ta": "ta",
    "bacmet_compound": "metal",
    "oritdb_role": "conj_role",
    "mobileog_category": "mge",
    "dbapis_family": "antidefence",
    "acrdb_family": "antidefence",
}
TERM_TYPES = ("amr", "metal", "ta", "conj_role", "mge", "antidefence")

# --- Fixed values: mobility classes, most complete first ----------------------------------
MOBILITY_CLASSES = (("T4SS_type", "pCONJ"), ("dCONJ_type", "pdCONJ"), ("MOB", "pMOB"))
NO_MOBILITY = "pMOBless"

# --- Fixed values: transferred classes, most informative first ----------------------------
TRANSFER_CLASSES = ("ANNOTATED", "UNKNOWN_ORTHOLOG", "NONE")
NO_VALUE = "-"

# --- Fixed values: context features -------------------------------------------------------
CONTEXT_FEATURES = ("defence", "integron", "is_element", "annotated_neighbour",
                    "operon_with_annotated", "two_gene_operon", "conj")

# --- Fixed values: evidence dimensions ----------------------------------------------------
DIMENSIONS = ("ORF_QC", "SEQUENCE_HOMOLOGY", "ORTHOLOGY", "GENOMIC_CONTEXT",
              "EVOLUTIONARY_CONSERVATION", "DISTRIBUTION", "STRUCTURAL_RELATIONSHIP",
              "PROTEIN_PROPERTIES")

# --- Fixed values: host names ------------------------------------------------------------
NOT_AN_ORGANISM = (r"(?i)^(NA|none|unknown|unidentified|uncultured|unclassified|environmental|"
                   r"synthetic|cloning|vector|expression|shuttle|mixed|bacterium|bacteria|"
                   r"prokaryote|archaeon)\b|metagenome|\bplasmid\b|virus\b")
NOT_A_SPECIES = ("sp.", "sp", "spp.", "cf.", "genomosp.", "endosymbiont", "symbiont")
GENUS = r"^(\[[A-Z][a-z]+\]|[A-Z][a-z]+)$"
HIGHER_RANK = r"(aceae|ales|ota)$"
UNNAMED_MEMBER = ("bacterium", "cyanobacterium", "archaeon")
EUKARYOTA = 2759

# --- Fixed values: feature-file escapes (the percent sign first) and layout ---------------
GFF3_ESCAPES = (("%", "%25"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), (",", "%2C"),
                ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D"))

# --- Fixed values: the sentinels of the merged phage table that mean absence --------------
MERGED_ABSENT = ("None", "No_PHROG", "No_MMseqs", "No_PHROGs_HMM", "NA", "")

# --- Fixed values: columns of the element caller's per-record table -----------------------
INTEGRON_COLUMNS = ("ID_integron", "ID_replicon", "element", "pos_beg", "pos_end", "strand",
                    "evalue", "type_elt", "annotation", "model", "type", "default",
                    "distance_2attC", "considered_topology")
