"""The ten tables of the nested JSON datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.functions.html import clean_html
from foliate.functions.multilingual import join_list, localized
from foliate.functions.nested import array_len, array_len_or_null, current_child, first_child, latest_by
from foliate.functions.text import blank_to_null, review_round_id, stage_label
from foliate.operators.filters import drop_nonpositive, keep_keyed, published_details, published_rows
from foliate.operators.joins import dimension_label, inner_with_loss, left_join_last, order_of, unambiguous_lookup
from foliate.operators.reshape import explode_children, explode_ordered
from foliate.plans import specs
from foliate.schema import conform

# Section ids and their titles.
SECTIONS = {
    1: "Peer-reviewed Articles",
    2: "Commentary",
    3: "Letter from the Editor",
    4: "Peer-reviewed Research Notes",
    6: "Special Issue: Digital Intersectionality and Marginalization in Majority World",
}

SUBMISSION_PART_OF_PUBLICATION = (
    "submission_id",
    "title",
    "author_name",
    "author_email",
    "author_count",
    "abstract",
    "submission_type",
    "keywords",
    "doi",
    "url",
    "date_submitted",
    "date_published",
    "issue_id",
)


def _carry_seq(df: DataFrame) -> list:
    return [F.col("_seq")] if "_seq" in df.columns else []


def normalize_submissions(
    submissions: DataFrame,
    publications: DataFrame,
    submissions_ext: DataFrame | None = None,
    sections: Mapping[int, str] | DataFrame = SECTIONS,
    unique_sides: bool = False,
) -> DataFrame:
    """One row per submission, its version details and its latest review round.

    The detail and extended sides are cut down to the few values the table needs
    before anything is shuffled; author arrays never travel. All three inputs meet
    on the submission id, so each is exchanged once. ``unique_sides`` skips the
    last-one-wins step for datasets whose keys are known to be unique.
    """
    first_author = first_child(F.col("authors"))
    details = publications.select(
        F.col("_submission_id"),
        "abstract",
        "keywords",
        F.col("recommendedReviewers").alias("recommended_reviewers"),
        first_author["familyName"].alias("author_name"),
        first_author["email"].alias("author_email"),
        array_len_or_null(F.col("authors")).alias("author_count"),
        F.col("issueId").alias("issue_id"),
        *_carry_seq(publications),
    )
    parsed = {c: localized(F.col(c)) for c in ("abstract", "recommended_reviewers", "author_name")} | {"keywords": join_list(F.col("keywords"))}
    # Values are parsed once the last record is picked. Without a place of arrival the parsed values say which is the last.
    late = "_seq" in publications.columns
    details = details if late else details.withColumns(parsed)

    current = current_child(F.col("publications"), "id", F.col("currentPublicationId"))
    base = submissions.withColumn("__current", current).select(
        F.col("id").alias("submission_id"),
        localized(F.col("__current.fullTitle")).alias("title"),
        F.col("__current.sectionId").alias("__section_id"),
        F.col("statusLabel").alias("status"),
        F.col("__current.urlPublished").alias("url"),
        F.col("__current.`pub-id::doi`").alias("doi"),
        F.col("dateSubmitted").alias("date_submitted"),
        F.col("lastModified").alias("last_modified"),
        F.col("dateLastActivity").alias("date_last_activity"),
        F.col("__current.datePublished").alias("date_published"),
        F.col("stageId").alias("stage_id"),
    )
    base = dimension_label(base, "__section_id", "submission_type", sections).drop("__section_id")
    joined = left_join_last(base, details, "submission_id", "_submission_id", order_of(details), unique_sides)
    joined = joined.withColumns(parsed) if late else joined
    # Cleaned once a submission's last record is picked, so no text is cleaned to be dropped.
    joined = clean_html(joined.drop("_seq"), {"abstract": "text", "recommended_reviewers": "lines"})
    if submissions_ext is None:
        joined = joined.withColumns(
            {"review_round": F.lit(None).cast("bigint"), "review_round_status": F.lit(None).cast("string")}
        )
    else:
        rounds = submissions_ext.withColumn("__latest", latest_by(F.col("reviewRounds"), "stageId", "round")).select(
            F.col("id"),
            F.col("__latest.round").alias("review_round"),
            F.col("__latest.status").alias("review_round_status"),
            *_carry_seq(submissions_ext),
        )
        joined = left_join_last(joined, rounds, "submission_id", "id", order_of(rounds), unique_sides).drop("_seq")
    return conform(joined, specs.SUBMISSIONS)


def publication_details(publications: DataFrame) -> DataFrame:
    """The columns of a published version that come from its own record."""
    return published_details(publications).select(
        F.col("_submission_id").alias("submission_id"),
        F.col("id").alias("publication_id"),
        F.col("version"),
        localized(F.col("subtitle")).alias("subtitle"),
        blank_to_null(F.col("authorsString")).alias("authors_string"),
        blank_to_null(F.col("pages")).alias("pages"),
        F.col("seq"),
        array_len(F.col("galleys")).alias("galley_count"),
        blank_to_null(F.col("locale")).alias("locale"),
        blank_to_null(F.col("licenseUrl")).alias("license_url"),
        localized(F.col("copyrightHolder")).alias("copyright_holder"),
        F.col("copyrightYear").alias("copyright_year"),
    )


def normalize_publications(submissions_df: DataFrame, publications: DataFrame) -> DataFrame:
    """Published submissions beside their published versions; one row per version record."""
    return publications_with_loss(submissions_df, publications)[0]


def publications_with_loss(submissions_df: DataFrame, publications: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The publications table, and how many published submissions have no published version."""
    published = published_rows(submissions_df).select(*SUBMISSION_PART_OF_PUBLICATION)
    joined, lost = inner_with_loss(published, publication_details(publications), "submission_id")
    return conform(joined, specs.PUBLICATIONS), lost


def normalize_authors(publications: DataFrame, users: DataFrame) -> DataFrame:
    """Authors in display order, with the account that alone has their email."""
    numbered = explode_ordered(publications, "authors", "seq", ["_submission_id"], "author_number", "author")
    flat = numbered.select(
        F.col("_submission_id").alias("submission_id"),
        F.col("author_number"),
        localized(F.col("author.givenName")).alias("given_name"),
        localized(F.col("author.familyName")).alias("family_name"),
        blank_to_null(F.col("author.orcid")).alias("orcid_id"),
        blank_to_null(F.col("author.country")).alias("country"),
        localized(F.col("author.affiliation")).alias("affiliation"),
        blank_to_null(F.col("author.email")).alias("email"),
    )
    row_id = ["submission_id", "author_number"]
    matched = unambiguous_lookup(flat, users, "email", "email", "id", "user_id", row_id)
    return conform(matched, specs.AUTHORS)


def normalize_review_assignments(submissions_ext: DataFrame) -> DataFrame:
    rows = explode_children(submissions_ext, "reviewAssignments", ["id"], "assignment")
    flat = rows.select(
        F.col("id").alias("submission_id"),
        F.col("assignment.id").alias("assignment_id"),
        F.col("assignment.round").alias("round"),
        F.col("assignment.roundId").alias("round_id"),
        F.col("assignment.statusId").alias("status_id"),
        F.col("assignment.status").alias("status"),
        F.col("assignment.due").alias("due"),
        F.col("assignment.responseDue").alias("response_due"),
    )
    return conform(flat, specs.REVIEW_ASSIGNMENTS)


def normalize_users(users: DataFrame, user_details: DataFrame | None = None, unique_details: bool = False) -> DataFrame:
    flat = users.select(
        F.col("id").alias("user_id"),
        blank_to_null(F.col("userName")).alias("username"),
        blank_to_null(F.col("email")).alias("email"),
        blank_to_null(F.col("fullName")).alias("full_name"),
        blank_to_null(F.col("orcid")).alias("orcid"),
        F.col("disabled"),
    )
    if user_details is None:
        return conform(flat, specs.USERS, fill_missing=True)
    details = user_details.select(
        F.col("id"),
        blank_to_null(F.col("country")).alias("country"),
        localized(F.col("affiliation"), fallback_any=True).alias("affiliation"),
        blank_to_null(F.col("dateRegistered")).alias("date_registered"),
        blank_to_null(F.col("dateLastLogin")).alias("date_last_login"),
        F.col("_fetched_at").alias("details_fetched_at"),
        *_carry_seq(user_details),
    )
    joined = left_join_last(flat, details, "user_id", "id", order_of(details), unique_details)
    return conform(joined.drop("_seq"), specs.USERS)


def normalize_user_groups(users: DataFrame) -> DataFrame:
    rows = explode_children(users, "groups", ["id"], "group")
    flat = rows.select(
        F.col("id").alias("user_id"),
        F.col("group.id").alias("group_id"),
        localized(F.col("group.name"), fallback_any=True).alias("group_name"),
        localized(F.col("group.abbrev"), fallback_any=True).alias("group_abbrev"),
        F.col("group.roleId").alias("role_id"),
    )
    return conform(flat, specs.USER_GROUPS)


def normalize_submission_files(files: DataFrame) -> DataFrame:
    flat = files.select(
        F.col("_submission_id").alias("submission_id"),
        F.col("id").alias("submission_file_id"),
        F.col("fileId").alias("file_id"),
        F.col("fileStage").alias("file_stage"),
        stage_label(F.col("fileStage")).alias("file_stage_label"),
        review_round_id(F.col("assocType"), F.col("assocId")).alias("review_round_id"),
        F.col("genreId").alias("genre_id"),
        localized(F.col("name")).alias("name"),
        F.col("mimetype"),
        F.col("documentType").alias("document_type"),
        F.col("uploaderUserId").alias("uploader_user_id"),
        F.col("sourceSubmissionFileId").alias("source_submission_file_id"),
        array_len(F.col("revisions")).alias("revision_count"),
        F.col("createdAt").alias("created_at"),
        F.col("updatedAt").alias("updated_at"),
        F.col("url"),
    )
    return conform(flat, specs.SUBMISSION_FILES)


def normalize_publication_stats(stats: DataFrame) -> DataFrame:
    flat = stats.select(
        F.col("publication.id").alias("submission_id"),
        F.col("abstractViews").alias("abstract_views"),
        F.col("galleyViews").alias("galley_views"),
        F.col("pdfViews").alias("pdf_views"),
        F.col("htmlViews").alias("html_views"),
        F.col("otherViews").alias("other_views"),
    )
    return conform(keep_keyed(flat, "submission_id"), specs.PUBLICATION_STATS)


def normalize_views_timeline(timeline: DataFrame) -> DataFrame:
    flat = timeline.select(
        F.col("_submission_id").alias("submission_id"), "date", "interval", F.col("value").alias("views"), "kind"
    )
    return conform(drop_nonpositive(flat, "views"), specs.VIEWS_TIMELINE)


def normalize_views_timeline_totals(timeline: DataFrame) -> DataFrame:
    flat = timeline.select("date", "interval", F.col("value").alias("views"), "kind")
    return conform(flat, specs.VIEWS_TIMELINE_TOTALS)


def timeline_rollup(views: DataFrame) -> DataFrame:
    """Journal-wide totals out of the kept per-submission points (zeros add nothing)."""
    return views.groupBy("interval", "date", "kind").agg(F.sum("views").alias("views"))


def normalize_api(datasets: Mapping[str, DataFrame | None], unique_sides: bool = False) -> dict[str, DataFrame]:
    """All tables the given datasets allow; an optional table is absent when its dataset is.

    The frames are lazy and publications is built on submissions. To write both,
    write submissions first and build publications on the written table, as
    ``jobs.run_normalize_api`` does.
    """
    submissions = normalize_submissions(
        datasets["submissions"], datasets["publications"], datasets["_submissions"], unique_sides=unique_sides
    )
    tables = {
        "submissions": submissions,
        "publications": normalize_publications(submissions, datasets["publications"]),
        "authors": normalize_authors(datasets["publications"], datasets["users"]),
        "review_assignments": normalize_review_assignments(datasets["_submissions"]),
        "users": normalize_users(datasets["users"], datasets.get("user_details"), unique_sides),
        "user_groups": normalize_user_groups(datasets["users"]),
    }
    optional = {
        "submission_files": normalize_submission_files,
        "publication_stats": normalize_publication_stats,
        "views_timeline": normalize_views_timeline,
        "views_timeline_totals": normalize_views_timeline_totals,
    }
    for name, build in optional.items():
        if datasets.get(name) is not None:
            tables[name] = build(datasets[name])
    return tables
