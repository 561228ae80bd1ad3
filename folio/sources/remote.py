"""Files, listings and records from other machines. Whatever opens an address takes `opener`, a picklable function of an address
and a time limit that gives a binary stream, so that all of it can be tried on local files."""

from __future__ import annotations

import hashlib
import os
import re
import time
from collections.abc import Callable, Iterator
from urllib.parse import urlencode
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import listed_names

#: Seconds for an answer, tries of a download, names in listings, most ids of one fetch.
TIMEOUT, TRIES, PAUSE = 20, 10, 5
CITATION_FILES, FULLTEXT_FILES = r"pubmed\w+.xml.gz", r"\S+.tar.gz"
MOST_IDS = 10
FETCH = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi"
#: The input format of each database that records are fetched from.
DATABASES = {"pubmed": "pubmedxml", "pmc": "pmcxml"}


def opened(url: str, timeout: float):
    return urlopen(url, timeout=timeout)


def _read(url: str, opener) -> Iterator[bytes]:
    with opener(url, TIMEOUT) as r:
        while part := r.read(1 << 20):
            yield part


def published_md5(url: str, opener=opened) -> str:
    """The sum that the side file `url`.md5 names."""
    line = b"".join(_read(f"{url}.md5", opener)).decode().strip()
    got = re.fullmatch(r"MD5\(.*=\s*([0-9a-fA-F]+)", line)
    if not got:
        raise ValueError(f"no checksum in {line[:80]!r}")
    return got[1].lower()


def download(url: str, path: str, md5: bool = False, opener=opened, tries: int = TRIES, wait: Callable[[float], None] = time.sleep) -> str:
    """Streams url to path and returns its MD5. The file appears there whole: it is written beside and renamed. A failed try is
    followed by a pause, each longer than the one before; after the last, RuntimeError."""
    part, why = f"{path}.{os.getpid()}.part", None
    for k in range(tries):
        if k:
            wait(PAUSE * k)
        try:
            want, got = published_md5(url, opener) if md5 else None, hashlib.md5()
            with open(part, "wb") as f:
                for b in _read(url, opener):
                    f.write(b)
                    got.update(b)
            if want not in (None, got.hexdigest()):
                raise ValueError(f"checksum {got.hexdigest()} is not {want}")
            os.replace(part, path)
            return got.hexdigest()
        except Exception as e:  # whatever it was, the next try may do
            why = e
            if os.path.exists(part):
                os.remove(part)
    raise RuntimeError(f"can't download {url}: {why}") from why


def downloads(urls: DataFrame, folder: str, md5: bool = False, opener=opened, tries: int = TRIES, name: Callable[[str], str] = os.path.basename) -> DataFrame:
    """(url, path, fetched) after downloading every url (column `url`) to `folder`, a mounted folder that all executors share.
    Tasks download side by side; a file that is there already isn't fetched again, so a task that is repeated goes on."""

    def run(batches):
        for b in batches:
            rows = []
            for u in b["url"]:
                at = os.path.join(folder, name(u))
                new = not os.path.exists(at)
                if new:
                    download(u, at, md5, opener, tries)
                rows.append((u, at, new))
            yield pd.DataFrame(rows, columns=["url", "path", "fetched"])

    return urls.select("url").where("url is not null").distinct().mapInPandas(run, "url string, path string, fetched boolean")


def listing(spark: SparkSession, folders: list[str], pattern: str, required: bool = False, opener=opened) -> DataFrame:
    """(ord, url): the files of remote folders whose names fit the pattern, folder by folder, each by name and once. With
    `required`, a folder that lists none raises. A listing is one page; the driver reads them."""
    pages = spark.createDataFrame([(i, f, b"".join(_read(f, opener)).decode()) for i, f in enumerate(folders)], "i int, folder string, page string")
    names = pages.select("i", "folder", listed_names(F.col("page"), pattern).alias("names"))
    if required:
        none = F.raise_error(F.concat(F.lit("no files at "), F.col("folder"))).cast("array<string>")
        names = names.withColumn("names", F.when(F.size("names") > 0, F.col("names")).otherwise(none))
    return names.select("i", F.posexplode(F.col("names")).alias("k", "name"), "folder").select(F.struct("i", "k").alias("ord"), F.concat("folder", "name").alias("url"))


def local_name(url: str) -> str:
    """The name that an archive is kept under: by its release and its base name."""
    base = os.path.basename(url)
    return f"{'baseline' if '.baseline.' in base else 'update'}.{base}"


def fetch(database: str, ids: list[str], folder: str, email: str, opener=opened) -> list[str]:
    """Writes the record of each id to a file of `folder`, which all executors share, and returns the paths."""
    if database not in DATABASES:
        raise ValueError(f"{database} is not one of {'/'.join(DATABASES)}")
    if len(ids) > MOST_IDS:
        raise ValueError(f"{len(ids)} ids; at most {MOST_IDS} can be fetched")
    if not email:
        raise ValueError("an email address is required")
    paths = []
    for i in ids:
        paths.append(os.path.join(folder, f"{database}_{re.sub(r'[^0-9A-Za-z.]', '_', i)}.xml"))
        query = urlencode({"db": database, "id": i, "rettype": "gb", "retmode": "xml", "email": email})
        download(f"{FETCH}?{query}", paths[-1], opener=opener, tries=1)
    return paths
