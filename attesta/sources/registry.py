"""Register files and seed maps: readers, tables and indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from attesta import lexicon as lx
from attesta.functions.text import digits, lit_strings
from attesta.functions.urls import mail_host

# Header names of the register export, dotted and as shown to people.
REGISTRY_HEADERS = {
    "org": ["organisasjonsnummer", "Organisasjonsnummer"],
    "name": ["navn", "Navn"],
    "legal_form": ["organisasjonsform.kode", "Organisasjonsform.kode"],
    "employees": ["antallAnsatte", "Antall ansatte"],
    "bankrupt": ["konkurs", "Konkurs"],
    "liquidating": ["underAvvikling", "Under avvikling"],
    "municipality": ["forretningsadresse.kommune", "Forretningsadresse.kommune"],
    "municipality_number": ["forretningsadresse.kommunenummer", "Forretningsadresse.kommunenummer"],
    "industry_code": ["naeringskode1.kode", "Næringskode1.kode"],
    "industry_label": ["naeringskode1.beskrivelse", "Næringskode1.beskrivelse"],
    "website": ["hjemmeside", "Hjemmeside"],
    "latest_submitted_accounts": ["sisteInnsendteAarsregnskap", "Siste innsendte årsregnskap"],
    "email": ["epostadresse", "Epostadresse"],
    "phone": ["telefon", "Telefon"],
    "mobile": ["mobil", "Mobil"],
    "vat_registered": ["registrertIMvaregisteret", "Registrert i Mva-registeret"],
    "business_registered": ["registrertIForetaksregisteret", "Registrert i Foretaksregisteret"],
}
SUBUNIT_HEADERS = {
    "subunit_org": ["organisasjonsnummer", "Organisasjonsnummer"],
    "parent_org": ["overordnetEnhet", "Overordnet enhet", "overordnetEnhet.organisasjonsnummer"],
    "name": ["navn", "Navn"],
    "legal_form": ["organisasjonsform.kode", "Organisasjonsform.kode"],
    "employees": ["antallAnsatte", "Antall ansatte"],
    "municipality": ["beliggenhetsadresse.kommune", "forretningsadresse.kommune", "Beliggenhetsadresse kommune"],
    "municipality_number": ["beliggenhetsadresse.kommunenummer", "forretningsadresse.kommunenummer", "Beliggenhetsadresse kommunenummer"],
    "industry_code": ["naeringskode1.kode", "Næringskode1.kode"],
    "industry_label": ["naeringskode1.beskrivelse", "Næringskode1.beskrivelse"],
    "website": ["hjemmeside", "Hjemmeside"],
    "email": ["epostadresse", "Epostadresse"],
}
FLAGS = {"bankrupt", "liquidating", "vat_registered", "business_registered"}
INDEX_MAIL_HOSTS = [
    "gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "icloud.com",
    "live.com", "online.no", "broadpark.no", "frisurf.no", "lyse.net",
    "c2i.net", "getmail.no", "altibox.no", "hesbynett.no", "ntebb.no",
    "enivest.net", "bluezone.no", "ebpost.no", "haugnett.no", "me.com",
    "msn.com", "protonmail.com", "proton.me", "start.no",
]


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose separator is whichever of ; , tab the header uses most."""
    header = spark.read.text(path).limit(1).collect()
    line = header[0][0] if header else ""
    separator = max(";,\t", key=line.count)
    rows = spark.read.csv(path, header=True, sep=separator, quote='"', escape='"', multiLine=False)
    # Row order inside one file; a later row replaces an earlier one of the same key.
    return rows.withColumn("pos", F.monotonically_increasing_id())


def project_headers(raw: DataFrame, headers: dict[str, list[str]]) -> DataFrame:
    """Typed columns from whichever header variants the file has; blanks become NULL."""
    known = {c.lstrip("﻿"): c for c in raw.columns}

    def pick(name: str) -> Column:
        found = [F.nullif(F.trim(F.col(f"`{known[v]}`")), F.lit("")) for v in headers[name] if v in known]
        value = F.coalesce(*found) if found else F.lit(None).cast("string")
        if name == "employees":
            return value.try_cast("int")
        if name in FLAGS:
            return F.coalesce(F.lower(value) == "true", F.lit(False))
        return value

    extra = ["pos"] if "pos" in raw.columns else []
    return raw.select(*extra, *[pick(name).alias(name) for name in headers])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Register export (plain or gz) as typed rows with a nine-character key."""
    return project_headers(read_delimited(spark, path), REGISTRY_HEADERS).filter(F.length("org") == 9)


def read_subunits(spark: SparkSession, path: str) -> DataFrame:
    return project_headers(read_delimited(spark, path), SUBUNIT_HEADERS)


def latest_rows(rows: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """One row per key, the last one written; an aggregate, so a hot key combines early."""
    carried = [c for c in rows.columns if c not in (key, pos)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*carried), pos).alias("row"))
    return best.select(key, "row.*")


def build_registry_table(raw: DataFrame) -> DataFrame:
    """Upsert by organisation number; rows without nine digits are left out."""
    return latest_rows(raw.filter(F.col("org").rlike("^[0-9]{9}$")), "org")


def registry_counters(raw: DataFrame, source_bytes_sha256: Column | None = None) -> DataFrame:
    """One metadata row: rows read, rows with a valid key, distinct keys."""
    valid = F.col("org").rlike("^[0-9]{9}$")
    return raw.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.coalesce(valid, F.lit(False))).alias("rows_indexed"),
        F.count_distinct(F.when(valid, F.col("org"))).alias("companies"),
    ).withColumn("source_sha256", source_bytes_sha256 if source_bytes_sha256 is not None else F.lit(None).cast("string"))


def write_registry_table(table: DataFrame, path: str) -> None:
    """Sorted by municipality so that file statistics prune geographic screens."""
    table.repartitionByRange("municipality_number", "org").sortWithinPartitions("municipality_number", "org").write.mode(
        "overwrite"
    ).parquet(path)


def build_subunit_table(raw: DataFrame) -> DataFrame:
    """Valid child and parent ids only, last row per child."""
    nine = "^[0-9]{9}$"
    return latest_rows(raw.filter(F.col("subunit_org").rlike(nine) & F.col("parent_org").rlike(nine)), "subunit_org")


def subunit_parents(subunits: DataFrame) -> DataFrame:
    return subunits.groupBy("parent_org").agg(F.count(F.lit(1)).alias("subunits"), F.sum("employees").alias("employees"))


def write_subunit_table(table: DataFrame, name: str, buckets: int = 256) -> None:
    """Bucketed by parent, so parent joins of the same bucket count need no shuffle."""
    table.write.mode("overwrite").bucketBy(buckets, "parent_org").sortBy("parent_org").saveAsTable(name)


# ---- manifests ----

# Accepted keys.
LIST_KEYS = ["organisations", "organisation_numbers", "companies", "manifest", "items", "rows", "data"]
ORG_KEYS = ["organisation_number", "organisasjonsnummer", "orgnr", "org_nr", "id"]
NAME_KEYS = ["name", "navn", "input_name"]


def _manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; one row per file only where the file is a single JSON document."""
    lines = spark.read.text(path)
    first = lines.filter(F.length(F.trim("value")) > 0).limit(1).select(
        F.col("value"), F.try_parse_json("value").isNull().alias("open")
    ).collect()
    opening = first[0]["value"].lstrip("﻿ \t") if first else ""
    if opening[:1] in ("[", "{") and first[0]["open"]:
        lines = spark.read.text(path, wholetext=True)
    return lines.select(F.trim(F.regexp_replace("value", "^﻿", "")).alias("text"), F.monotonically_increasing_id().alias("line"))


def read_manifest(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(pos, org, name) from JSON, JSONL, CSV or plain lines; the first mention of an org wins.

    Strict mode raises on any entry without nine digits and on repeats.
    """
    lines = _manifest_lines(spark, path).filter((F.length("text") > 0) & ~F.col("text").startswith("#"))
    parsed = lines.withColumn("v", F.try_parse_json("text"))
    wrapped = [F.try_variant_get("v", f"$.{k}", "array<variant>") for k in LIST_KEYS]
    items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), *wrapped, F.array("v"))
    # Only a line that is no JSON is read as text; the text of a list would come with each of its entries.
    opened = parsed.select("line", F.when(F.col("v").isNull(), F.col("text")).alias("text"), items.alias("items"))
    rows = opened.select("line", "text", F.posexplode("items").alias("place", "item"))

    fields = [F.nullif(F.try_variant_get("item", f"$.{k}", "string"), F.lit("")) for k in ORG_KEYS]
    names = [F.nullif(F.try_variant_get("item", f"$.{k}", "string"), F.lit("")) for k in NAME_KEYS]
    scalar = F.coalesce(F.try_variant_get("item", "$", "string"), F.when(F.col("item").isNull(), F.col("text")))
    parts = F.transform(F.split(scalar, ","), lambda p: F.trim(F.regexp_replace(p, "[\"']", "")))
    listed = F.element_at(F.filter(F.transform(parts, digits), lambda d: F.length(d) == 9), 1)
    is_object = F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False))
    raw = F.when(is_object, F.coalesce(*fields)).otherwise(
        F.when(F.contains(scalar, F.lit(",")), F.try_element_at(F.filter(F.transform(parts, digits), lambda d: F.length(d) == 9), F.lit(1))).otherwise(scalar)
    )
    second = F.try_element_at(parts, F.lit(2))
    name = F.when(is_object, F.coalesce(*names)).otherwise(F.when(digits(second) != digits(raw), second))
    found = rows.select("line", "place", digits(raw).alias("org"), F.nullif(name, F.lit("")).alias("name"))
    valid = found.filter(F.length("org") == 9)
    order = F.struct("line", "place")
    unique = valid.groupBy("org").agg(F.min(order).alias("pos"), F.min_by("name", order).alias("name"), F.count(F.lit(1)).alias("mentions"))
    if strict:
        bad = found.filter(F.length("org") != 9).limit(1).collect()
        if bad:
            raise ValueError(f"invalid organisation number {bad[0]['org']!r}")
        if unique.filter("mentions > 1").limit(1).collect():
            raise ValueError("organisation numbers repeat")
    return unique.select("pos", "org", "name")


def read_org_map(spark: SparkSession, path: str, id_path: str = "org_nr") -> DataFrame:
    """(org, row VARIANT) of ``{org: row}`` JSON; a row whose own id is another org is left out."""
    text = spark.read.text(path, wholetext=True).withColumn("v", F.try_parse_json("value"))
    pairs = text.select(F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("org", "row"))
    return pairs.filter(F.try_variant_get("row", f"$.{id_path}", "string") == F.col("org"))


# ---- domains and seeds ----


def build_domain_index(registry: DataFrame) -> DataFrame:
    """(org, homepage, mail domain, phone, municipality) for entities with a site or own mail domain."""
    mail = F.nullif(mail_host(F.col("email")), F.lit(""))
    own = F.when(~mail.isin(INDEX_MAIL_HOSTS), mail)
    blank = F.lit("")
    return registry.select(
        "org",
        F.nullif(F.trim("website"), blank).alias("homepage"),
        own.alias("mail_domain"),
        F.coalesce(F.nullif(F.trim("phone"), blank), F.nullif(F.trim("mobile"), blank)).alias("phone"),
        F.nullif(F.trim("municipality"), blank).alias("municipality"),
    ).filter(F.col("homepage").isNotNull() | F.col("mail_domain").isNotNull())


def domain_index_coverage(registry: DataFrame) -> DataFrame:
    mail = F.nullif(mail_host(F.col("email")), F.lit(""))
    site = F.length(F.trim(F.coalesce("website", F.lit("")))) > 0
    own = F.coalesce(mail.isNotNull() & ~mail.isin(INDEX_MAIL_HOSTS), F.lit(False))
    return registry.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(site).alias("with_homepage"), F.count_if(mail.isNotNull()).alias("with_email"),
        F.count_if(own).alias("with_own_domain"), F.count_if(site | own).alias("indexed"),
    )


def _bare_site(url: Column) -> Column:
    stripped = F.replace(F.replace(url, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    return F.nullif(F.regexp_replace(F.trim(stripped), "^/+|/+$", ""), F.lit(""))


def merge_seed_maps(base: DataFrame, incoming: DataFrame) -> DataFrame:
    """Base (org, homepage, mail_domain) completed from incoming (org, website, profile_url).

    A homepage already there is kept; the profile address always comes from the newcomer.
    """
    joined = base.join(incoming.select("org", "website", "profile_url"), "org", "full")
    return joined.select(
        "org",
        F.coalesce(F.nullif("homepage", F.lit("")), _bare_site(F.col("website"))).alias("homepage"),
        "mail_domain",
        F.nullif(F.trim("profile_url"), F.lit("")).alias("profile_url"),
    )


def crawl_targets(index: DataFrame) -> DataFrame:
    """Distinct lower-case hosts worth crawling, from homepages and mail domains."""
    sites = index.select(F.explode(F.array("homepage", "mail_domain")).alias("site"))
    name = F.replace(F.regexp_extract(F.lower("site"), "^([^/]*)", 1), F.lit("www."), F.lit(""))
    return sites.select(name.alias("host")).filter(F.contains("host", F.lit("."))).distinct()


def seed_problems(profiles: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds that must stop the job: unknown entity, or a site or proof address that is not absolute."""
    absolute = "^https?://"
    checked = seeds.join(profiles.select("org").distinct().withColumn("known", F.lit(True)), "org", "left")
    reason = F.when(F.col("known").isNull(), "unknown organisation").when(
        ~F.coalesce(F.trim("website").rlike(absolute) & F.trim("proof_url").rlike(absolute), F.lit(False)),
        "website and proof_url must be absolute",
    )
    return checked.select("org", reason.alias("reason")).filter(F.col("reason").isNotNull())


def apply_verified_seeds(profiles: DataFrame, seeds: DataFrame) -> DataFrame:
    """Reviewed homepages replace the profile's lead; any bad seed fails the whole job."""
    bad = seed_problems(profiles, seeds).limit(5).collect()
    if bad:
        raise ValueError("bad seeds: " + ", ".join(f"{r['org']} ({r['reason']})" for r in bad))
    chosen = seeds.select("org", F.trim("website").alias("seed_site"), F.trim("proof_url").alias("seed_proof_url"))
    return profiles.join(chosen, "org", "left").select(
        *[F.coalesce("seed_site", "website").alias("website") if c == "website" else F.col(c) for c in profiles.columns],
        F.when(F.col("seed_site").isNotNull(), "independently_verified_exact_entity").alias("website_seed_source"),
        "seed_proof_url",
    )


def select_from_registry(registry: DataFrame, manifest: DataFrame) -> DataFrame:
    """Register rows of the manifest's entities, with the manifest position to order by."""
    return manifest.select("org", "pos").join(registry, "org")


def missing_from_registry(registry: DataFrame, manifest: DataFrame) -> DataFrame:
    return manifest.select("org", "pos").join(registry.select("org"), "org", "left_anti")


def seed_coverage(sources: dict[str, DataFrame]) -> DataFrame:
    """One row: entities per source, in the union, and in one source only.

    Each source is reduced to its distinct entities first; one shuffle then folds
    them into a bit mask per entity.
    """
    tagged = None
    for bit, frame in enumerate(sources.values()):
        part = frame.select("org").distinct().withColumn("mask", F.lit(1 << bit))
        tagged = part if tagged is None else tagged.unionAll(part)
    masks = tagged.groupBy("org").agg(F.bit_or("mask").alias("mask"))
    columns = [F.count(F.lit(1)).alias("companies")]
    for bit, name in enumerate(sources):
        columns.append(F.count_if(F.col("mask").bitwiseAND(1 << bit) != 0).alias(f"in_{name}"))
        columns.append(F.count_if(F.col("mask") == (1 << bit)).alias(f"only_{name}"))
    return masks.agg(*columns)
