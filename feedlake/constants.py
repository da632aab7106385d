"""Fixed values.

Word lists, lookup tables and numeric limits that results depend on. Every one
is only a default: the operators take each as a keyword argument.
"""

from datetime import timedelta

# --- fixed values: title signals per kind, matched lower-cased -------------
# Signals with surrounding blanks need a word boundary on that side.
DIGEST_SIGNALS = ("balance of power", "(podcast)", "(video)")
DIGEST_SUFFIX = ", more"
SPAM_SIGNALS = (
    "lead plaintiff", "class action", "deadline alert", "shareholder rights law firm",
    "suffered losses in", "encourages investors", "reminds investors", "securities fraud",
    "bragar eagel", "rosen law", "pomerantz", "levi & korsinsky", "glancy prongay",
    "kahn swick", "robbins geller", "faruqi", "schall law", "hagens berman",
    "kessler topaz", "bronstein, gewirtz", "gross law firm", "johnson fistel",
    "kirby mcinerney", "would be worth this much today", "if an investor had bought",
)
SPORTS_SIGNALS = (
    "한국시리즈", "프로야구", " kbo", "k리그", "프리미어리그", "월드컵", "올림픽",
    "premier league", "world cup", " nba ", " mlb ", " nfl ", "la liga", "bundesliga",
)
STORY, DIGEST, SPAM, SPORTS = "story", "digest", "spam", "sports"

# --- fixed values: host name -> publisher label ----------------------------
PUBLISHERS = {
    "mk.co.kr": "매일경제", "hankyung.com": "한국경제", "wowtv.co.kr": "한국경제TV",
    "sedaily.com": "서울경제", "edaily.co.kr": "이데일리", "fnnews.com": "파이낸셜뉴스",
    "mt.co.kr": "머니투데이", "moneys.co.kr": "머니S", "etoday.co.kr": "이투데이",
    "asiae.co.kr": "아시아경제", "ajunews.com": "아주경제", "newspim.com": "뉴스핌",
    "g-enews.com": "글로벌이코노믹", "heraldcorp.com": "헤럴드경제", "thebell.co.kr": "더벨",
    "businesspost.co.kr": "비즈니스포스트", "yna.co.kr": "연합뉴스", "einfomax.co.kr": "연합인포맥스",
    "news1.kr": "뉴스1", "newsis.com": "뉴시스", "etnews.com": "전자신문", "dt.co.kr": "디지털타임스",
    "digitaltoday.co.kr": "디지털투데이", "zdnet.co.kr": "ZDNet Korea", "inews24.com": "아이뉴스24",
    "chosun.com": "조선일보", "biz.chosun.com": "조선비즈", "joongang.co.kr": "중앙일보",
    "donga.com": "동아일보", "hani.co.kr": "한겨레", "khan.co.kr": "경향신문",
    "seoul.co.kr": "서울신문", "kmib.co.kr": "국민일보", "hankookilbo.com": "한국일보",
    "tokenpost.kr": "토큰포스트", "coinreaders.com": "코인리더스", "pinpointnews.co.kr": "핀포인트뉴스",
    "topstarnews.net": "톱스타뉴스", "ytn.co.kr": "YTN",
}
HOST_PREFIXES = ("www", "m", "news", "n", "view", "biz", "it")
PORTAL_HOST_MARK = "naver."
PORTAL_LABEL = "네이버"

# --- fixed values: source families and feed-id prefixes --------------------
RSS, SEARCH, FIREHOSE = "rss", "naver", "fmp"
FAMILIES = (RSS, SEARCH, FIREHOSE)
SEARCH_PREFIX = "naver:"
FIREHOSE_PREFIX = "fmp:"
FIREHOSE_DEFAULT_SOURCE = "FMP"
ARTICLE_ENDPOINT = "fmp-articles"
ARTICLE_DEFAULT_SOURCE = "Financial Modeling Prep"

# --- fixed values: registry domains and defaults ---------------------------
BODY_MODES = ("full", "summary", "headline")
TIERS = ("primary", "analysis", "wire")
SEARCH_DISPLAY = 100

# --- fixed values: clocks --------------------------------------------------
FIREHOSE_ZONE = "America/New_York"
BLACKOUT_ZONE = "Asia/Seoul"
LOOKBACK_DAYS = 3

# --- fixed values: paging --------------------------------------------------
PAGE_SIZE = 250
PAGE_CAP = 100
PAGE_CAPS = {ARTICLE_ENDPOINT: 2}
UNBOUNDED_ENDPOINTS = (ARTICLE_ENDPOINT,)
TRUNCATED_NOTE = "truncated at page cap"

# --- fixed values: retention and embedding contract ------------------------
TTL = timedelta(days=365)
MIN_LIFE = timedelta(days=2)
EMBED_MODEL = "gemini-embedding-001"
EMBED_TASK_TYPE = "RETRIEVAL_DOCUMENT"
EMBED_DIM = 768
EMBED_BODY_CHARS = 500
ITEM_ERROR_CODES = (400,)
STALL_ROUNDS = 2

# --- fixed values: health --------------------------------------------------
FAIL_RATE = 0.5
CHRONIC_STREAK = 5
MIN_ATTEMPTED = 10
FEED_ERROR_CHARS = 300
JOB_ERROR_CHARS = 280

# --- fixed values: page bodies ---------------------------------------------
MIN_BODY_CHARS = 80
EMPTY_RATE_ALERT = 0.5

# --- fixed values: status board --------------------------------------------
PERIOD_SECONDS = 900
OVERDUE_FACTOR = 3
LEAD_FRACTION = 0.4
HEADLINE_CHARS = 44
LEVELS = ("ok", "warn", "bad")
JOB_TEXT = {
    "none": "미실행", "fail": "실패", "stuck": "멈춤(정지)",
    "running": "실행 중", "late": "지연(안 돎)", "ok": "정상",
}
AGO_TEXT = {"now": "방금", "minutes": "분 전", "hours": "시간 전", "days": "일 전"}
LEVEL_TITLES = {
    "ok": "모두 정상", "warn": "주의가 필요합니다", "bad": "점검이 필요합니다",
}
NO_RECORD, NO_DATA, NO_ITEMS = "기록 없음", "없음", "수집된 데이터 없음"
LATEST_PREFIX = "최근: "
