"""Addresses of official records; null where no page of a record is known: a citation is never made up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public pages of the sources, of records where there are such ("{}" is the filing or transaction id) and of the data.
RECORD_PAGES = {
    "CAL-ACCESS": ("filing", "https://cal-access.sos.ca.gov/PDFGen/pdfgen.prg?filingid={}&amendid=0"),
    "NYSBOE": ("tran", "https://data.ny.gov/resource/4j2b-6a2j.json?trans_number={}"),
    "WA-PDC": ("filing", "https://my.pdc.wa.gov/public/document?repno={}"),
}
DATA_PAGES = {
    "NYSBOE": "https://data.ny.gov/d/4j2b-6a2j",
    "ISBE": "https://www.elections.il.gov/CampaignDisclosure/ContributionSearchByAllContributions.aspx",
    "PA-DOS": "https://www.pa.gov/agencies/dos/resources/voting-and-elections-resources/campaign-finance-data",
    "WA-PDC": "https://data.wa.gov/d/kv7h-kjye",
    "CO-TRACER": "https://tracer.sos.colorado.gov/PublicSite/DataDownload.aspx",
    "AZ-SOS": "https://seethemoney.az.gov/",
    "MN-CFB": "https://cfb.mn.gov/reports-and-data/self-help/data-downloads/campaign-finance/",
    "FL-DOE": "https://dos.elections.myflorida.com/campaign-finance/contributions/",
}
FEDERAL_FILING = "https://www.fec.gov/data/filings/?file_number={}"


def _filled(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def source_links(source: Column, filing: Column, tran: Column) -> Column:
    """struct<filing_url, dataset_url> of a state record; pages that need an id are there only with it, and so is the data page beside them."""
    src, given = F.upper(source), {"filing": F.nullif(filing, F.lit("")), "tran": F.nullif(tran, F.lit(""))}
    page, data = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (kind, template) in RECORD_PAGES.items():
        page = F.when(src == name, _filled(template, given[kind])).otherwise(page)
    for name, url in DATA_PAGES.items():
        there = (src == name) & given[RECORD_PAGES[name][0]].isNotNull() if name in RECORD_PAGES else src == name
        data = F.when(there, url).otherwise(data)
    return F.struct(page.alias("filing_url"), data.alias("dataset_url"))


def federal_filing(filing: Column) -> Column:
    """The page of a federal filing by its number; other ids have none."""
    number = F.btrim(filing)
    return F.when(F.rlike(number, F.lit("^[0-9]+$")), _filled(FEDERAL_FILING, number))
