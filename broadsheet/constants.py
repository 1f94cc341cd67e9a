"""Fixed values. Results depend on these lists, patterns and thresholds, so they are stated as they are.

``\\b`` in the patterns means an ASCII word boundary; ``patterns.java`` translates it for Spark.
"""

# --- Fixed values: white space as the rules understand it -------------------------------------
WS = "\t\n\x0b\x0c\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# --- Fixed values: URLs ---------------------------------------------------------------------------
TRACKING_PARAM = r"(?i)^(utm_|gclid$|fbclid$|mc_cid$|mc_eid$|oc$)"
RELAY_URL = r"(?i)^https?://(?:news\.)?google\.[^/]+/rss/articles/"
UNSAFE_PATH = r"(?i)(?:/search[/?]|/tag[/?]|/category[/?]|/author[/?]|/login|/subscribe)"
GENERIC_IMAGE_HOST = r"(?i)(^|\.)googleusercontent\.com$|(^|\.)gstatic\.com$"
GENERIC_IMAGE_PATH = (
    r"(?i)main[\s_-]*visual[\s_-]*green[\s_-]*website"
    r"|(?:^|[/_-])(?:logo|placeholder|default|generic|fallback|social-preview|share-image)(?:[/_\-.]|$)"
)
DOI = r"(?i)^10\.\d{4,9}/\S+$"

# --- Fixed values: feed guards and limits ----------------------------------------------------------
FEED_MAX_AGE_DAYS = 10
PAPER_MIN_CHARS = 150
PAYWALL = r"(?i)members only|log in/register"

# --- Fixed values: selection -----------------------------------------------------------------------
MIN_RELEVANCE = 5
BRIEF_MIN_RELEVANCE = 3
ITEMS_PER_ISSUE = 42
BRIEFS_PER_ISSUE = 90
DAILY_TARGET = 40
DAILY_MINIMUM = 30
DAILY_DEEP = 15
DAILY_RSS = 100
ISSUE_MIN = 4
BRIEF_MIN_CHARS = 250
ANALYSIS_MIN_CHARS = 420
RELEVANCE_TERMS = (
    r"veterin|animal health|animal hospital|pet health|dog|cat|canine|feline|equine|veterinary|zoon|rabies"
    r"|parasit|antimicrobial|clinical|journal|medicine|병원|동물|수의|반려|질환|감염|백신|논문|임상"
)

# --- Fixed values: quality rules -------------------------------------------------------------------
CONTENT_TIERS = ("brief", "analysis", "evidence")
CARD_BLOCKERS = (
    "title-missing", "body-missing", "foreign-script", "banned-term", "garbled-text", "template-text", "internal-ascii",
)
BANNED_TERMS = (
    "Invol", "ractical", "말 이 교육", "세번서", "폴크 County", "병원ugeom", "조객 참여", "원-health", "무뎌지",
    "백식", "백석", "수수의료진", "proprietários",
)
FOREIGN_SCRIPT = r"[一-鿿぀-ヿЀ-ӿ]"
UNTRANSLATED = (
    r"(?i)\b(?:Hernia|fleas|corticosteroid|Oligodendroglioma|Taurine|Microbiome|historicas|alongside|efficacy"
    r"|literature|refractory|site|generic|Responsible|organism|endogenous|exogenous|probiotic|hospital|owner|Trial"
    r"|Pilot|Veterinarian|Practice|Nutrition|physiological demand|dietary supplementation)\b"
)
GARBLED = r"(?i)말\s*이\s*교육|세번서|폴크\s+County|\b(?:Invol|ractical)\b"
TEMPLATE = (
    r"(?i)(?:\b(?:lorem ipsum|tbd|todo|placeholder|insert here|제목을 입력|본문을 입력|여기에 입력|자동 생성|생성된 요약)\b"
    r"|\[\s*(?:제목|본문|내용|출처)\s*\])"
)
INTERNAL_ASCII = r"[가-힣][A-Za-z]{2,}[가-힣]"
BAD_PARTICLE = (
    r"(?:^|[\s,])(?:을를|를을|이가|가이|은는|는은|의의|으로로|에에|와과|하고고)(?:$|[\s,.!?])|주인의 위한|과의의"
)
REPEATED_WORD = r"(?i)(?:\b([A-Za-z가-힣]{2,})\s+\1\b|([가-힣]{2,})\s+\2)"
SENTENCE_END = r"(?:[.!?。！？]|습니다|입니다|합니다|됩니다|있습니다)\s*$"
HANGUL = r"[가-힣]"
HANGUL_TAIL = r"[가-힣0-9)]$"

# --- Fixed values: risk and review ------------------------------------------------------------------
HIGH_RISK = r"(?i)약물|용량|투여|처치|치료 선택|응급|진단 지침|예후|dose|dosage|emergency|prognos|treatment recommendation"
MEDIUM_RISK = r"(?i)임상|질환|증례|검사|보호자|환자|연구|clinical|disease|patient|study"
LOW_RISK = r"(?i)병원 경영|채용|인력|업계|정책|시장|커리어|industry|management|policy"
CLINICAL_ACTION = r"(?i)권고|투여|용량|처치|치료|진단|응급|예후|임상 적용|환자에게"
REVIEW_POLICY_DATE = "2026-07-29"
RISKS = ("low", "medium", "high")
WORKFLOW_STATUSES = (
    "draft", "automated", "editor-review-required", "vet-review-required", "approved", "published",
    "correction-required", "archived", "legacy-published", "editor-reviewed", "vet-reviewed",
)
OPEN_WORKFLOW = (
    "draft", "automated", "editor-review-required", "vet-review-required", "correction-required", "archived",
)
QUEUE_STATUSES = (
    "legacy-published", "draft", "automated", "editor-review-required", "vet-review-required", "correction-required",
)
PUBLICATION_STATUSES = (
    "internal-draft", "public-brief", "index-low-risk", "index-news", "index-analysis", "blocked-clinical",
)
CHECKLIST = (
    "sourceConfirmed", "titleLeadBodyChecked", "numbersChecked", "speciesAndStudyChecked", "limitationsChecked",
    "clinicalLanguageChecked",
)
UNSAFE_PHRASES = (
    r"반드시\s*(?:투여|사용|치료|처치)(?:해야)?",
    r"권장\s*용량",
    r"치료해야\s*한다",
    r"(?:환자|동물|개|고양이)는?\s*안전하다",
    r"효과가\s*입증됐다",
    r"완치",
    r"즉시\s*약물(?:을)?\s*사용",
    r"진단할\s*수\s*있다",
    r"예방할\s*수\s*있다",
)

# --- Fixed values: evidence and audits --------------------------------------------------------------
EVIDENCE_FIELDS = (
    "studyType", "speciesStudied", "sampleSize", "intervention", "comparator", "primaryOutcome", "evidenceLevel",
    "limitations", "journal", "doi", "institution", "funding", "conflictOfInterest",
)
NUMBER_TOKEN = (
    r"(?i)(?:\b(?:n|N|sample(?: size)?|표본(?: 수)?|대상)\s*[=:]?\s*\d[\d,.]*"
    r"|\d[\d,.]*\s*(?:mg|μg|ug|mL|ml|IU|%|개월|주|일|년|세|마리|명|건|배|시간|분)|\b\d[\d,.]*%)"
)
PLAIN_NUMBER = r"(?i)\b\d+(?:[,.]\d+)?\s*(?:mg|μg|mcg|mL|ml|IU|%|개월|주|일|마리|명|세)?\b"
UNIT_NUMBER = r"(?i)\b\d+(?:[,.]\d+)?\s*(?:mg|μg|mcg|mL|ml|IU|%|개월|주|일|마리|명|세|kg|mmHg|mm|cm)?\b"
CORRECTION_WORDS = r"(?i)(?:correction|erratum|retraction|withdrawn|정정|철회|오류)"
KNOWN_ERRORS = (
    "병원ugeom", "강아지 주인의 위한", "무뎌지", "원-health", "조객 참여", "백식", "백석", "각제", "수아지",
)
TITLE_ENGLISH = r"(?i)\b(?:the|and|with|for|from|study|patient|randomized)\b"
SUPERLATIVE = r"\b(최초|입증|완치)\b"
SUPERLATIVE_ANY = r"최초|입증|완치"
CASE_REPORT = r"(?i)증례|case report"
GENERALISING = r"모든|일반적으로|입증|효과가 있다"
# Known errors with a safe replacement: (text, class, confidence).
SAFE_REPLACEMENTS = (("병원ugeom", "typo", 0.99), ("조객 참여", "terminology", 0.97), ("라신County", "spacing", 0.99))
COMMON_ACRONYMS = (
    "AI", "API", "CBC", "CGM", "CT", "DNA", "DOI", "ETCO2", "FDA", "FIV", "GP", "H5N1", "HCT", "IDEXX", "ILE", "IU",
    "KPI", "mL", "MRI", "NSAID", "PIMS", "PLE", "RSS", "SII", "STT", "TTA", "WHO", "X-ray",
)
SPECIES = {
    "개": ("dog", "canine", "puppy"), "강아지": ("dog", "puppy", "canine"), "고양이": ("cat", "feline", "kitten"),
    "말": ("horse", "equine", "foal"), "소": ("cattle", "bovine", "cow", "calf"), "돼지": ("pig", "swine", "porcine"),
    "가금": ("poultry", "chicken", "avian"), "조류": ("avian", "bird", "poultry"), "토끼": ("rabbit",), "페럿": ("ferret",),
}
DIRECTIVE = r"(?:권고|권장|투여|용량|처방|처치|치료해야|진단해야|응급 처치|반드시 .{0,12}해야)"
BIBLIOGRAPHIC_MARKERS = (r"(?i)\bIn:\s*", r"(?i)Research output|연구 성과", r"(?i)peer[- ]reviewed|동료 검토", r"›")
NARRATIVE = (
    r"(?i)\b(?:when|however|because|researchers|developed|helps|found|shows|suggests|is|are|was|were)\b[^.?!]{20,}[.?!]"
)
EXTERNAL_LINK = r"(?i)(?:external news link|외부 뉴스 링크)\s*https?://"
BLOCKING_LANGUAGE = r"^(korean-internal-ascii|known-error:|untranslated-title|repeated-paragraph)"
BLOCKING_CLAIM = r"^(species-mismatch|case-report-generalization)$"

# --- Fixed values: images ---------------------------------------------------------------------------
IMAGE_OWNERSHIPS = ("owned", "licensed", "official-press", "source-embed", "unknown")
IMAGE_APPROVED = ("owned", "licensed", "official-press", "source-embed")

# --- Fixed values: page contract --------------------------------------------------------------------
PRIMARY_TYPES = {
    "article": ("Article", "NewsArticle", "Report"),
    "collection": ("CollectionPage", "ItemList", "WebPage"),
    "topic": ("CollectionPage", "ItemList"),
    "page": ("WebPage", "AboutPage", "CollectionPage"),
}


# --- Fixed values: keywords -------------------------------------------------------------------------
KEYWORD_STOPWORDS = ("관리", "방법", "정보", "추천", "가격", "비용", "종류", "증상", "원인", "치료")
KEYWORD_CONTEXT = r"강아지|고양이|반려|애완|동물병원|수의|펫|댕댕|냥이|견종|말티즈|푸들|포메|시츄|리트리버|비숑|치와와|진돗개|고냥|묘|犬"
CAT_WORDS = r"고양이|반려묘|냥"
DOG_WORDS = r"강아지|반려견|개\b|견"
PERFORMANCE_HEADERS = {
    "date": ("date", "Date", "날짜"),
    "query": ("query", "Query", "검색어"),
    "page": ("page", "Page", "페이지", "URL"),
    "country": ("country", "Country", "국가"),
    "device": ("device", "Device", "기기"),
    "impressions": ("impressions", "Impressions", "노출수", "노출"),
    "clicks": ("clicks", "Clicks", "클릭수", "클릭"),
    "ctr": ("ctr", "CTR", "클릭률"),
    "position": ("position", "Position", "평균순위"),
}
KEYWORD_HEADERS = {
    "keyword": ("연관키워드", "키워드", "keyword", "Keyword"),
    "pc": ("월간검색수(PC)", "월간검색수PC", "monthlyPcQcCnt", "PC검색량"),
    "mobile": ("월간검색수(모바일)", "월간검색수모바일", "monthlyMobileQcCnt", "모바일검색량"),
    "competition": ("경쟁정도", "competitionIndex", "경쟁강도"),
}

# --- Fixed values: topics (slug, match) -------------------------------------------------------------
TOPICS = (
    ("영양-비만", "영양|사료|비만|체중|식이|다이어트|급여"),
    ("행동", "행동|불안|스트레스|사회화|공격성|분리불안"),
    ("감염-백신", "백신|감염|바이러스|세균|기생충|예방접종|전염"),
    ("마취-통증", "마취|진통|통증|NSAID|진정"),
    ("피부-귀", "피부|아토피|외이염|귀염|가려움|알레르기|탈모"),
    ("종양", "종양|림프종|비만세포종|항암|육종|악성|전이"),
    ("신장-비뇨", "신장|신부전|방광|요로|결석|배뇨|만성신장"),
    ("항생제-내성", "항생제|내성|항균|antimicrobial"),
    ("안과", "각막|망막|녹내장|백내장|결막|안과|안구"),
    ("정형-관절", "관절염|슬개골|십자인대|TPLO|고관절|골절|정형|파행"),
    ("신경", "신경|발작|디스크|척수|근무력|간질|마비"),
    ("내분비", "갑상선|당뇨|쿠싱|부신|인슐린|호르몬"),
    ("응급-중환자", "응급|중환자|쇼크|수혈|심폐소생|위급"),
    ("치과", "치과|치아|발치|치주|구강|스케일링"),
    ("심장", "심장|승모판|심부전|심근|부정맥"),
    ("병원경영", "경영|채용|인력|매출|마케팅|리더십|번아웃|진료수가|인수합병|병원 인수"),
    ("진단-검사", "영상 진단|초음파|방사선|엑스레이|X-ray|CT|MRI|내시경|생검|혈액검사|검사법|판독|바이오마커|MCHC|CHCM"),
    ("수의IT-AI", "인공지능|머신러닝|PIMS|전자차트|수의 소프트웨어|원격진료|텔레메디신|워크플로우|디지털 전환|개방형 API"),
)
TOPIC_BODY_MIN_HITS = 2

# --- Fixed values: rewrite rules (pattern, replacement), applied in this order -----------------------
REWRITE_RULES = (
    (r"(?i)\bHernia\b", "탈장"), (r"(?i)\bfleas\b", "벼룩"), (r"(?i)\bcorticosteroid\b", "코르티코스테로이드"),
    (r"(?i)\bOligodendroglioma\b", "희소돌기아교종"), (r"(?i)\bTaurine\b", "타우린"),
    (r"(?i)\bMicrobiome\b", "미생물군집"), (r"(?i)\befficacy\b", "유효성"), (r"(?i)\brefractory\b", "난치성"),
    (r"(?i)\bbacteriocin\b", "박테리오신"), (r"(?i)\bsite\b", "부위"), (r"(?i)\bgeneric\b", "제네릭"),
    (r"(?i)\bResponsible\b", "책임 있는"), (r"(?i)\borganism\b", "생물"), (r"(?i)\bendogenous\b", "내인성"),
    (r"(?i)\bexogenous\b", "외인성"), (r"(?i)\bprobiotic\b", "프로바이오틱"), (r"(?i)\bhospital\b", "병원"),
    (r"(?i)\bowner\b", "보호자"), (r"(?i)\bTrial\b", "임상시험"), (r"(?i)\bPilot\b", "파일럿"),
    (r"(?i)\bVeterinarian\b", "수의사"), (r"(?i)\bPractice\b", "진료"), (r"(?i)\bNutrition\b", "영양"),
)

# --- Fixed values: month names of paper dates ---------------------------------------------------------
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
