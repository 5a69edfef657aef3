"""Word lists, host lists, states and thresholds the results depend on."""

# ---- fixed values: states and thresholds ----
AVAILABILITY_STATES = ["available", "not_available", "blocked", "not_applicable", "ambiguous", "failed"]
TERMINAL_STATES = [
    "complete", "not_applicable", "not_found", "blocked_policy", "blocked_robots",
    "source_error", "budget_exhausted", "submission_error",
]
PUBLISH_THRESHOLD = 0.90
REVIEW_THRESHOLD = 0.80
TIER_GRANTS = {"shell": 3, "standard": 12, "rich": 30}

# ---- fixed values: words inside legal names ----
LEGAL_FORMS = [
    "as", "asa", "ans", "da", "enk", "iks", "sa", "sam", "sti", "nuf", "ba",
    "bbl", "brl", "esek", "fli", "ks", "spa", "kf", "sf", "ab", "oy", "aps",
    "gmbh", "ltd", "limited", "inc", "plc", "llc", "bv", "nv",
    "borettslag", "boligbyggelag", "boligsameie", "sameiet", "sameie",
]
STOPWORDS = ["og", "and", "the", "for", "med", "av", "i", "pa", "til"]
FILLER_WORDS = [
    "norge", "norway", "nordic", "scandinavia", "holding", "invest", "eiendom",
    "drift", "service", "revisjon", "revisjonsfirmaet", "stiftelsen", "stiftelse",
    "stifting", "stiftinga",
    "gruppen", "gruppe", "group", "konsern", "partnere", "partner",
]
NAME_NOISE = LEGAL_FORMS + STOPWORDS + FILLER_WORDS
NAME_NOISE_BASE = LEGAL_FORMS + STOPWORDS

EMPLOYER_SUFFIXES = [
    "as", "asa", "ans", "da", "enk", "nuf", "sa", "ks", "sti", "stiftelsen",
    "brl", "bbl", "sf", "iks", "samvirkeforetak", "ba",
]
EMPLOYER_SUFFIX_PAIRS = ["fl i"]
JOB_BOARD_LEGAL_FORMS = [
    "as", "asa", "ans", "da", "sa", "nuf", "ba", "enk", "ks", "se", "sti", "iks", "kf", "sf",
]
OWNER_GENERIC = [
    "as", "asa", "ans", "da", "enk", "iks", "sa", "sam", "sti", "stiftelsen",
    "nuf", "ab", "b", "v", "limited", "ltd", "inc", "plc", "the", "og", "and",
]
LEAD_LEGAL = [
    "as", "asa", "ans", "da", "enk", "nuf", "sa", "sti", "ks", "ba", "brl", "bbl", "esek", "iks",
    "sf", "hf", "inc", "ltd", "limited", "stiftelsen", "stiftelse", "borettslag", "sameie",
]
LEAD_TAILS = [
    "products", "norge", "norway", "drift", "service", "services", "eiendom", "invest", "holding",
    "utleie", "consulting", "solutions", "teknikk", "partner", "handel", "industri", "gruppen", "group",
]
LEAD_GENERIC_FIRST = LEAD_TAILS + ["sameiet", "borettslaget", "stiftelsen", "foreningen", "the"]
SEED_GUESS_GENERIC = [
    "as", "asa", "ans", "da", "enk", "nuf", "sa", "sti", "stiftelsen", "the", "and", "og",
]
LABEL_FILLER = [
    "as", "asa", "ans", "da", "enk", "iks", "sa", "nuf", "ab", "aps", "gmbh", "oy",
    "ba", "bbl", "brl", "ks", "kf", "sf", "og", "and", "the", "avd", "avdeling", "norge", "norway",
    "holding", "invest", "gruppen", "gruppe", "group", "konsern", "eiendom",
    "eiendommer", "drift", "service", "as.", "co", "company", "int",
    "international", "scandinavia", "nordic", "no",
    "syd", "nord", "vest", "ost", "aust", "spesialist", "spesialister",
]
LABEL_STEM_ENDINGS = [
    "service", "drift", "transport", "motor", "konsern", "spesialist", "spesialister", "fysioterapi",
    "fysioterapisenter", "bygg", "ror", "mekaniske", "regnskap",
]
SEARCH_GENERIC_NAMES = [
    "as", "asa", "ans", "da", "enk", "sa", "nuf", "company", "norge", "norway", "gruppen", "group",
]
QUERY_LEGAL_SUFFIXES = [
    "AS", "ASA", "ANS", "DA", "ENK", "SA", "NUF", "KS", "BA", "BRL", "BBL", "FLI", "IKS", "SF",
]
PASSIVE_TIER_WORDS = ["holding", "invest", "eiendom", "eiendommer", "borettslag", "sameie"]
PASSIVE_SEARCH_WORDS = ["holding", "holdings", "invest", "eiendom", "eiendommer", "borettslag", "sameie"]
DORMANT_NAME_WORDS = ["holding", "invest", "eiendom", "sameie", "borettslag"]

# ---- fixed values: legal forms by accounting rule ----
ALWAYS_ACCOUNTING_FORMS = ["AS", "ASA", "BRL", "BBL", "STI", "SF", "VPFO"]
THRESHOLD_ACCOUNTING_FORMS = [
    "ENK", "ANS", "DA", "SA", "FLI", "ESEK", "NUF", "UTLA", "ORGL", "SAM", "SPA", "KS", "BO",
]

# ---- fixed values: hosts that list many companies ----
DIRECTORY_HOSTS = [
    "proff.no", "1881.no", "gulesider.no", "purehelp.no", "bizweb.no",
    "regnskapstall.no", "enhetsregisteret.no", "brreg.no", "forvalt.no",
    "nettbedrift.no", "firmaregister.no", "opplysningen.no", "linkedin.com",
    "facebook.com", "instagram.com", "x.com", "twitter.com", "youtube.com",
    "wikipedia.org", "yelp.com", "tripadvisor.com", "finn.no", "eniro.no",
    "1850.no", "byndle.no", "firmadatabasen.no", "listings.no", "vexter.no",
    "falio.no", "creditsafe.com", "kompass.com", "careerjet.no", "finansavisen.no",
    "aftenbladet.no", "foretaksinfo.no", "norwep.com", "dn.no", "e24.no",
    "norgelei.no", "bizin.eu", "acompio.com", "telefonterror.co.no", "nor47business.com",
    "styrerommet.no", "kragero-bbl.no", "bbl.no",
    "yra.no", "nol.no", "northdata.com", "dnb.com", "cylex.no", "1890.no",
    "vatverifier.com", "tracxn.com", "180.no", "infobel.com", "rosa.no",
    "nordicnet.no", "generate.no", "firmview.no", "sokfirma.no", "m.io.no",
    "bestilletransport.no", "utdanning.no",
    "banett.no", "budstikka.no", "varingen.no", "vg.no", "db.no", "nrk.no",
    "adressa.no", "ba.no", "bt.no", "rb.no", "fvn.no", "nordlys.no", "ta.no",
    "varden.no", "sb.no", "tb.no", "dt.no", "h-avis.no", "an.no", "itromso.no",
    "tk.no", "amta.no", "oblad.no", "moss-avis.no", "fredriksstad-blad.no",
    "smp.no", "nettavisen.no", "klassekampen.no", "dagsavisen.no", "morgenbladet.no",
    "forskning.no", "tu.no", "digi.no", "kode24.no", "shifter.no",
]
PUBLIC_SECTOR_SUFFIXES = ["kommune.no", "fylke.no", "gov.no", "mil.no"]
LISTING_HOSTS = [
    "brreg.no", "proff.no", "purehelp.no", "1881.no", "gulesider.no", "firmalisten.no",
    "companywall.no", "firmadatabasen.no", "sokfirma.no", "yra.no", "northdata.com",
    "nor47business.com", "regnskapstall.no", "vexter.no", "byndle.no", "draupner.com", "fagfolkguiden.no",
    "sgregister.dibk.no", "karrierestart.no", "dnb.com",
    "norgelei.no", "utdanning.no", "northdata.de", "largestcompanies.com",
]
SEARCH_BLOCKED_HOSTS = [
    "proff.no", "purehelp.no", "1881.no", "gulesider.no", "firmalisten.no", "companywall.no",
    "firmadatabasen.no", "sokfirma.no", "yra.no", "northdata.com", "nor47business.com",
    "linkedin.com", "facebook.com", "instagram.com", "x.com", "twitter.com", "youtube.com", "tiktok.com",
]
FREE_MAIL_HOSTS = [
    "gmail.com", "googlemail.com", "hotmail.com", "hotmail.no", "outlook.com",
    "yahoo.com", "yahoo.no", "icloud.com", "live.com", "live.no", "me.com",
    "online.no", "broadpark.no", "start.no", "c2i.net", "frisurf.no", "spray.no",
    "getmail.no", "telenor.no", "protonmail.com", "proton.me", "mail.com",
    "inbox.com", "zoho.com", "aol.com", "bluezone.no", "epost.no",
]
SHARED_MAIL_HOSTS = [
    "gmail.com", "hotmail.com", "outlook.com", "live.no", "live.com", "online.no", "yahoo.com",
    "icloud.com", "msn.com", "hotmail.no", "outlook.no",
]
# A short public-suffix list; pass a table for the full one.
PUBLIC_SUFFIXES = [
    "no", "com", "net", "org", "se", "dk", "fi", "eu", "io", "co", "app", "de", "uk", "co.uk", "org.uk",
    "ac.uk", "gov.uk", "co.no", "kommune.no", "fylke.no", "gs.no", "info", "biz", "shop", "store", "online",
    "as", "nu", "is", "nl", "be", "fr", "es", "it", "pl", "ch", "at", "us", "ai", "dev", "cloud", "site",
]
SOCIAL_HOSTS = {
    "linkedin.com": "linkedin", "facebook.com": "facebook", "instagram.com": "instagram",
    "twitter.com": "x", "x.com": "x", "youtube.com": "youtube", "tiktok.com": "tiktok",
}

# ---- fixed values: page markers ----
PARKED_MARKERS = [
    "domain is for sale", "domenet er til salgs", "this domain is parked",
    "hugedomains", "domeneshop", "parked at", "buy this domain",
    "website coming soon", "under construction", "kommer snart",
    "her flytter snart", "default web page", "apache2 ubuntu default",
    "welcome to nginx", "index of /",
]
NETWORK_MARKERS = [
    "franchisetaker", "franchise", "vare medlemmer", "our portfolio companies",
    "portfolio companies", "portefoljeselskap", "portefoljeselskaper",
    "konsernet bestar av", "part of the group",
]
NORWEGIAN_PAGE_WORDS = [
    "organisasjonsnummer", "org.nr", "kontakt oss", "vart selskap", "vare tjenester",
    "alle rettigheter", "personvernerklaering", "postboks", "apningstider",
    "informasjonskapsler", "informasjonskapselpolicy", "kundeservice", "vart kontor",
]
OWNER_PARKED_MARKERS = [
    "domain is for sale", "domain for sale", "hugedomains", "parked at", "miss hosting",
    "parkert domene", "domenet er parkert", "her flytter snart en ny gjest", "has been informing visitors",
    "her kommer:", "her kommer snart", "coming soon", "website under construction",
    "find the best information and most relevant links on all topics related to",
]

# ---- fixed values: observation vocabulary ----
PLATFORMS = [
    "company_site", "google_places", "linkedin", "facebook", "instagram", "x", "youtube", "tiktok",
    "glassdoor", "indeed", "job_board", "news", "openstreetmap", "brreg", "apple_app_store",
    "google_play", "wikidata", "wikipedia", "company_directory",
]
SIGNAL_TYPES = [
    "company_profile", "profile_handle", "profile_metrics", "place_summary", "review", "review_summary",
    "job_posting", "workforce_snapshot", "public_post", "public_mention", "buzz_metrics",
]
PUBLISHABLE_MODES = ["official_api", "licensed_api", "company_authorized_export", "permitted_public_page"]
EXPERIMENTAL_MODES = ["jobspy_experiment", "unofficial_api_experiment", "rights_review_experiment"]
INDEPENDENT_OBSERVATION_CLASSES = [
    "customer_review", "employee_review", "licensed_news", "public_news", "public_mention",
]
SENTIMENT_LABELS = ["positive", "neutral", "negative", "mixed"]
INDEPENDENT_SENTIMENT_CLASSES = ["licensed_news", "public_news", "official_notice", "licensed_review"]
EXEMPT_SOURCE_CLASSES = [
    "official_registry", "official_annual_accounts", "official_job_board", "open_data",
    "public_news", "licensed_feed",
]
OFFICIAL_SOURCE_CLASSES = ["official_registry", "official_annual_accounts", "official_job_board"]
AUTHORITATIVE_ORIGINS = [
    "registry", "wikidata", "registry_email", "universe_snapshot", "registry_cctld_fallback", "google_places",
]
GATE_AUTHORITATIVE_ORIGINS = ["registry", "registry_email", "universe_snapshot", "registry_cctld_fallback"]
ORIGIN_PRIOR = {
    "registry": 0.97, "wikidata": 0.95, "registry_email": 0.94,
    "universe_snapshot": 0.93, "search": 0.55, "dns_guess": 0.45,
}

# ---- fixed values: headline words ----
POSITIVE_WORDS = [
    "vekst", "rekord", "rekordresultat", "overskudd", "doblet", "opptur",
    "økning", "jubelår", "suksess", "oppkjøp", "ekspanderer", "ansetter",
    "inntektsvekst", "fremgang", "vinner", "tildelt", "styrker",
]
NEGATIVE_WORDS = [
    "konkurs", "oppbud", "underskudd", "kutt", "kutter", "faller",
    "svikt", "varsel", "nedgang", "tap", "krise", "oppsigelser",
    "nedbemann", "sliter", "varsler", "klages", "kritikk", "straff", "tvang",
]

# ---- fixed values: months ----
MONTH_NUMBERS = {
    "januar": 1, "january": 1, "jan": 1, "februar": 2, "february": 2, "feb": 2,
    "mars": 3, "march": 3, "mar": 3, "april": 4, "apr": 4, "mai": 5, "may": 5,
    "juni": 6, "june": 6, "jun": 6, "juli": 7, "july": 7, "jul": 7,
    "august": 8, "aug": 8, "september": 9, "sep": 9, "sept": 9,
    "oktober": 10, "october": 10, "okt": 10, "oct": 10, "november": 11, "nov": 11,
    "desember": 12, "december": 12, "des": 12, "dec": 12,
}
NORWEGIAN_MONTHS = [
    "januar", "februar", "mars", "april", "mai", "juni", "juli", "august", "september", "oktober",
    "november", "desember",
]
ENGLISH_MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
    "november", "december",
]

# ---- fixed values: number words in workforce phrases ----
WORD_COUNTS = {"ingen": 0, "en": 1, "ett": 1, "to": 2, "tre": 3, "fire": 4, "fem": 5}

# ---- fixed values: register tracking ----
TRACKED_FIELDS = [
    "registry.name", "registry.legal_form", "registry.employees", "registry.municipality",
    "registry.website", "registry.latest_submitted_accounts", "financials.records",
    "financial_history.years", "roles.roles", "locations.locations", "website.title",
    "website.description", "website.social_links",
]
VOLATILE_METRICS = ["as_of", "active_as_of", "api_url", "provider_api_url"]
STRATEGIES = [
    "company_site_feed", "company_site_identity", "company_site_activity", "company_directory_identity",
    "verified_handle_extraction", "registry_workforce_snapshot", "about_contact_deep_pages",
    "youtube_channel_feed", "places_identity_resolution", "places_rating_reviews", "jobs_feed_discovery",
    "linkedin_workforce_snapshot", "annual_report_workforce_snapshot", "social_profile_metrics",
    "independent_news_discovery", "exact_entity_article_capture", "independent_sentiment",
    "buzz_peer_normalization",
]
