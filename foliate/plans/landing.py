"""Schemas of the landed JSON datasets.

Fields that are a locale map, a string or null are declared STRING, and so are
scalars that may come in any form; they are parsed or cast later, so that one odd
value never fails a read.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


SCHEMAS_DDL = {
    "submissions": (
        "id BIGINT, statusLabel STRING, dateSubmitted STRING, lastModified STRING, dateLastActivity STRING, "
        "stageId BIGINT, currentPublicationId BIGINT, publications ARRAY<STRUCT<id BIGINT, sectionId BIGINT, "
        "fullTitle STRING, urlPublished STRING, `pub-id::doi` STRING, datePublished STRING>>"
    ),
    "publications": (
        "_submission_id BIGINT, id BIGINT, status BIGINT, version BIGINT, subtitle STRING, authorsString STRING, "
        "pages STRING, seq BIGINT, locale STRING, licenseUrl STRING, copyrightHolder STRING, copyrightYear BIGINT, "
        "issueId BIGINT, abstract STRING, recommendedReviewers STRING, keywords STRING, "
        "galleys ARRAY<STRUCT<id BIGINT>>, authors ARRAY<STRUCT<seq DOUBLE, givenName STRING, familyName STRING, "
        "orcid STRING, country STRING, affiliation STRING, email STRING>>"
    ),
    "_submissions": (
        "id BIGINT, dateLastActivity STRING, reviewRounds ARRAY<STRUCT<id BIGINT, round BIGINT, stageId BIGINT, "
        "statusId BIGINT, status STRING>>, reviewAssignments ARRAY<STRUCT<id BIGINT, round BIGINT, roundId BIGINT, "
        "statusId BIGINT, status STRING, due STRING, responseDue STRING>>"
    ),
    "users": (
        "id BIGINT, userName STRING, email STRING, fullName STRING, orcid STRING, disabled BOOLEAN, "
        "groups ARRAY<STRUCT<id BIGINT, name STRING, abbrev STRING, roleId BIGINT>>"
    ),
    "user_details": (
        "id BIGINT, country STRING, affiliation STRING, dateRegistered STRING, dateLastLogin STRING, _fetched_at STRING"
    ),
    "submission_files": (
        "_submission_id BIGINT, id BIGINT, fileId BIGINT, fileStage BIGINT, genreId BIGINT, name STRING, "
        "mimetype STRING, documentType STRING, uploaderUserId BIGINT, sourceSubmissionFileId BIGINT, "
        "assocType BIGINT, assocId BIGINT, createdAt STRING, updatedAt STRING, url STRING, "
        "revisions ARRAY<STRUCT<fileId BIGINT, url STRING>>"
    ),
    "publication_stats": (
        "publication STRUCT<id BIGINT>, abstractViews BIGINT, galleyViews BIGINT, pdfViews BIGINT, "
        "htmlViews BIGINT, otherViews BIGINT"
    ),
    "views_timeline": "_submission_id BIGINT, date STRING, value BIGINT, kind STRING, interval STRING",
    "views_timeline_totals": "date STRING, value BIGINT, kind STRING, interval STRING",
}

REQUIRED = ("submissions", "publications", "_submissions", "users")
OPTIONAL = ("publication_stats", "views_timeline", "views_timeline_totals", "submission_files", "user_details")

# What identifies a record, per dataset: the key of an upsert.
MERGE_KEYS = {
    "submissions": ("id",),
    "_submissions": ("id",),
    "publications": ("_submission_id",),
    "submission_files": ("id",),
    "users": ("id",),
    "user_details": ("id",),
    "views_timeline": ("_submission_id", "interval", "date", "kind"),
    "views_timeline_totals": ("interval", "date", "kind"),
}


def schema_of(dataset: str) -> T.StructType:
    return _struct(SCHEMAS_DDL[dataset])


def required_schemas() -> dict[str, T.StructType]:
    return {name: schema_of(name) for name in REQUIRED}


def optional_schemas() -> dict[str, T.StructType]:
    return {name: schema_of(name) for name in OPTIONAL}
