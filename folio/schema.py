"""Schemas of the document model."""

ABSTRACT = """pmid bigint, pmcid string, doi string, year int, month int, day int, title array<string>, abstract array<string>,
journal string, journal_iso string, authors array<string>, chemicals array<struct<ui:string,name:string>>,
mesh array<struct<ui:string,major:string,name:string,qualifiers:array<struct<ui:string,major:string,name:string>>>>,
supp_mesh array<struct<ui:string,type:string,name:string>>, publication_types array<string>, errors array<string>"""

ANNOTATION = "struct<id:string,citation_text:string,offset:int,length:int>"

FULLTEXT = f"""sub_article int, pmid string, pmcid string, doi string, year int, month int, day int, journal string, journal_iso string,
passages array<struct<section:string,subsection:string,xml_path:string,text:string,annotations:array<{ANNOTATION}>>>, errors array<string>"""

MENTIONS = "pmid bigint, type string, conceptid string, mentions string, database string"
STORE = "kind string, pmid bigint, body string, hash bigint, updated bigint, file_index bigint"
GROUPS = "map<string,struct<src:string,`group`:array<string>>>"
