"""Fixed values.

Everything in this module is a constant that annotation results depend on: the
instruction text the labelling model was trained with, the closed label sets, the
token and size budgets, and the marker line of an unmaterialised corpus file. They
are stated here as plain text and nowhere else; all schemas, domain checks and
prompts of the package are derived from them.
"""

# --- fixed values: prompt text -------------------------------------------------

SYSTEM_PROMPT = """Annotate the document. Any language; assess quality within its linguistic norms. Return only a JSON object. Do not include markdown, code fences, or explanatory text.
content_integrity: technical completeness (complete|mostly_complete|fragment|severely_degraded)
content_ratio: content vs navigation/boilerplate ratio (complete_content|mostly_content|mixed_content|mostly_navigation|minimal_content)
content_length: substantive words (substantial 2k+|moderate 500-2k|brief 100-500|minimal <100)
one_sentence_description: neutral ~10 word summary in English
content_type[]: functional purpose (analytical|instructional|reference|procedural|qa_structured|conversational|creative|transactional|boilerplate|news_report|opinion_editorial|review_critique|technical_documentation|specification_standard|legal_document|press_release|structured_data|source_code)
business_sector[]: industry domain (academic_research|education_sector|technology_software|hardware_electronics|healthcare_medical|pharmaceutical_biotech|financial_services|legal_services|government_public|manufacturing_industrial|mining_resources|chemicals_materials|energy_utilities|retail_commerce|wholesale_distribution|real_estate_construction|transportation_logistics|automotive_industry|telecommunications|media_entertainment|advertising_marketing|hospitality_tourism|agriculture_food|environmental_services|aerospace_defense|insurance_industry|nonprofit_ngo|consulting_professional|human_resources|security_cyber|gaming_industry|gambling_betting|travel_aviation|food_beverage_hospitality|consumer_goods|general_interest|other)
technical_content[]: specialized knowledge (code_heavy|math_heavy|scientific|data_heavy|engineering|basic_technical|non_technical)
content_quality: writing/presentation quality (excellent|good|adequate|poor|unacceptable)
information_density: signal vs padding (dense|adequate|moderate|thin|empty)
educational_value: teaching potential (high|moderate|basic|minimal|none)
reasoning_indicators: logical analysis depth (analytical|explanatory|basic_reasoning|minimal|none)
audience_level: assumed background (expert|advanced|general|beginner|youth|children)
commercial_bias: promotional influence (none|minimal|moderate|heavy|pure_marketing)
time_sensitivity: temporal decay (evergreen|slowly_changing|regularly_updating|time_sensitive)
content_safety: harmful content (safe|mild_concerns|nsfw|harmful|illegal)
pii_presence: private individual data (no_pii|contains_pii)
regional_relevance[]: geographic/cultural context (european|north_american|east_asian|south_asian|southeast_asian|middle_eastern|sub_saharan_african|latin_american|oceanian|central_asian|russian_sphere|global|culturally_neutral|indeterminate)
country_relevance[]: specific countries as ISO names, or supranational|none
"""

DOCUMENT_OPEN = "<start_of_document>\n"
DOCUMENT_CLOSE = "\n<end_of_document>\n"
TRUNCATION_MARK = "\n<truncated_content>"

# --- fixed values: the 18 answer fields in output order ------------------------
# A tuple lists the closed label set; None means free text.

ANSWER_FIELDS = {
    "content_integrity": ("complete", "mostly_complete", "fragment", "severely_degraded"),
    "content_ratio": (
        "complete_content", "mostly_content", "mixed_content", "mostly_navigation",
        "minimal_content",
    ),
    "content_length": ("substantial", "moderate", "brief", "minimal"),
    "one_sentence_description": None,
    "content_type": (
        "analytical", "instructional", "reference", "procedural", "qa_structured",
        "conversational", "creative", "transactional", "boilerplate", "news_report",
        "opinion_editorial", "review_critique", "technical_documentation",
        "specification_standard", "legal_document", "press_release", "structured_data",
        "source_code",
    ),
    "business_sector": (
        "academic_research", "education_sector", "technology_software",
        "hardware_electronics", "healthcare_medical", "pharmaceutical_biotech",
        "financial_services", "legal_services", "government_public",
        "manufacturing_industrial", "mining_resources", "chemicals_materials",
        "energy_utilities", "retail_commerce", "wholesale_distribution",
        "real_estate_construction", "transportation_logistics", "automotive_industry",
        "telecommunications", "media_entertainment", "advertising_marketing",
        "hospitality_tourism", "agriculture_food", "environmental_services",
        "aerospace_defense", "insurance_industry", "nonprofit_ngo",
        "consulting_professional", "human_resources", "security_cyber", "gaming_industry",
        "gambling_betting", "travel_aviation", "food_beverage_hospitality",
        "consumer_goods", "general_interest", "other",
    ),
    "technical_content": (
        "code_heavy", "math_heavy", "scientific", "data_heavy", "engineering",
        "basic_technical", "non_technical",
    ),
    "information_density": ("dense", "adequate", "moderate", "thin", "empty"),
    "content_quality": ("excellent", "good", "adequate", "poor", "unacceptable"),
    "audience_level": ("expert", "advanced", "general", "beginner", "youth", "children"),
    "commercial_bias": ("none", "minimal", "moderate", "heavy", "pure_marketing"),
    "time_sensitivity": (
        "evergreen", "slowly_changing", "regularly_updating", "time_sensitive",
    ),
    "content_safety": ("safe", "mild_concerns", "nsfw", "harmful", "illegal"),
    "educational_value": ("high", "moderate", "basic", "minimal", "none"),
    "reasoning_indicators": (
        "analytical", "explanatory", "basic_reasoning", "minimal", "none",
    ),
    "pii_presence": ("no_pii", "contains_pii"),
    "regional_relevance": (
        "european", "north_american", "east_asian", "south_asian", "southeast_asian",
        "middle_eastern", "sub_saharan_african", "latin_american", "oceanian",
        "central_asian", "russian_sphere", "global", "culturally_neutral",
        "indeterminate",
    ),
    "country_relevance": None,
}

LIST_FIELDS = (
    "content_type", "business_sector", "technical_content", "regional_relevance",
    "country_relevance",
)
DESCRIPTION_FIELD = "one_sentence_description"
DESCRIPTION_MAX_CHARS = 200
FIELD_ALIASES = {"time_sensitivity": "time_sensitive"}

# --- fixed values: budgets and file markers ------------------------------------

MAX_CONTEXT_TOKENS = 8_192
MAX_CONTENT_CHARS = 50_000
OUTPUT_TOKEN_BUDGETS = (512, 1_024)
PROMPT_TOKEN_MARGIN = 256
BATCH_ROWS = 32
IN_FLIGHT_REQUESTS = 8

POINTER_FIRST_LINE = "version https://git-lfs.github.com/spec/v1"
PSEUDO_CORPUS = "default"
RESPONSE_NAME = "AnnotationResponse"

# Lower edges, in words, of the content_length bands named in the prompt.
LENGTH_BAND_EDGES = (("substantial", 2_000), ("moderate", 500), ("brief", 100))
