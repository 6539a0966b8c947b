"""One run over landed pages: all 32 steps for all listed repositories, and
the report that tells which steps are complete."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow import schemas
from prflow.operators import actors, discover, flatten, reconcile
from prflow.plans import loads
from prflow.plans.steps import STEP_BY_NAME, STEP_PARENTS, STEPS, Step
from prflow.plans.store import Store
from prflow.session import new_work_folder
from prflow.sinks import keyed
from prflow.sources import documents as D
from prflow.sources.pages import ACCEPTED, page_folder, read_parquet_pages, with_place

# The type whose documents refer to commits or users, per discovering step.
COMMIT_SOURCES = {
    "pr_commits": "PULL_REQUEST",
    "review_commits": "PULL_REQUEST_REVIEW",
    "review_comment_commits": "PULL_REQUEST_REVIEW_COMMENT",
}
USER_SOURCES = {
    "pr_users": "PULL_REQUEST",
    "pr_comment_users": "PULL_REQUEST_COMMENT",
    "review_users": "PULL_REQUEST_REVIEW",
    "review_comment_users": "PULL_REQUEST_REVIEW_COMMENT",
    "commit_users": "COMMIT",
    "commit_comment_users": "COMMIT_COMMENT",
}
_ACTOR_LISTS = ("participants", "edits", "reactions", "authors")
# Steps about all repositories at once.
GLOBAL_STEPS = (31, 32)


class Run:
    """``repositories`` is a list of {owner, name}; ``now`` stamps the
    repositories. Running again does the steps something new has come for."""

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        store: str,
        repositories: Iterable[Mapping[str, str]],
        now: datetime.datetime | None = None,
        parquet_pages: bool = False,
    ):
        repositories = list(repositories)
        self.spark = spark
        self.landing = landing
        self.store = Store(spark, store)
        self.wanted = D.repositories_df(spark, repositories)
        self.now = F.lit(now) if now is not None else F.current_timestamp()
        self.parquet_pages = parquet_pages
        self.skipped: list[str] = []  # steps of the last run() nothing new had come for
        pairs = sorted({(r["owner"], r["name"]) for r in repositories})
        self._about = hashlib.sha256(json.dumps([pairs, landing]).encode()).hexdigest()[:16]
        self._extents: dict[str, list[int] | None] = {}
        self._converted: set[str] = set()
        self._used: set[str] = set()
        self._lookups: dict[str, DataFrame] = {}
        self._running = False

    # -- inputs

    def refresh(self) -> None:
        """Look at the landing again: what has landed since counts."""
        self._extents, self._converted = {}, set()
        self._lookups = {name: df for name, df in self._lookups.items() if name == "scope"}

    def _extent(self, shape: str) -> list[int] | None:
        """Size of what has landed of a shape: files only come, so anything new
        changes it."""
        if shape not in self._extents:
            self._extents[shape] = self.store.files.extent(page_folder(self.landing, shape))
        return self._extents[shape]

    def _landed(self, shape: str) -> DataFrame:
        """All accepted pages of a shape; none if nothing of it has landed. The
        files that came since the last run are parsed at the first use."""
        self._used.add(shape)
        extent = self._extent(shape)
        if self.parquet_pages:
            if extent is None:
                return self.spark.createDataFrame([], schemas.page_schema(shape))
            return with_place(read_parquet_pages(self.spark, self.landing, shape))
        if shape not in self._converted and extent is not None:
            self.store.convert_pages(self.landing, shape)
        self._converted.add(shape)
        return self.store.landed_pages(shape).filter(F.col("outcome") == ACCEPTED).drop("outcome", "landed_file")

    def _again(self, shape: str, landed: DataFrame) -> DataFrame:
        return self._lookup(f"again-{shape}", lambda: flatten.asked_again(landed))

    def fetched(self, shape: str) -> DataFrame:
        """Accepted pages of each parent's latest fetch, copies included."""
        landed = self._landed(shape)
        return flatten.current_fetch(landed, again=self._again(shape, landed))

    def pages(self, shape: str) -> DataFrame:
        """The same with one copy of each page."""
        landed = self._landed(shape)
        return flatten.current_pages(landed, again=self._again(shape, landed))

    def failed_pages(self) -> DataFrame:
        """(shape, outcome, pages) of the parsed pages that were not accepted:
        with errors from the API, or without data and a reason."""
        counts = [self.spark.createDataFrame([], "shape string, outcome string, pages long")]
        for shape in () if self.parquet_pages else self.store.page_shapes():
            failed = self.store.landed_pages(shape).filter(F.col("outcome") != ACCEPTED)
            counted = failed.groupBy("outcome").agg(F.count("*").alias("pages"))
            counts.append(counted.select(F.lit(shape).alias("shape"), "outcome", "pages"))
        return reduce(DataFrame.unionByName, counts)

    def _lookup(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A lookup made once and written, so that its size is known to the
        joins of every step."""
        if name not in self._lookups:
            made = make()
            folder = new_work_folder(self.spark, name)
            made.write.parquet(folder)
            self._lookups[name] = self.spark.read.schema(made.schema).parquet(folder)
        return self._lookups[name]

    @property
    def scope(self) -> DataFrame:
        """Stored repositories of this run: (id, owner, name, total, place)."""

        def make() -> DataFrame:
            known = self.store.documents("REPOSITORY").select("id", "owner", "name", "total_pull_requests")
            return known.join(self.wanted, ["owner", "name"]).select("id", "owner", "name", "total_pull_requests", "place")

        self.store.read.add("documents/REPOSITORY")
        return self._lookup("scope", make)

    @property
    def buckets(self) -> list[int]:
        """Buckets of the store with rows of this run's repositories."""
        if "buckets" not in self._lookups:
            self._lookups["buckets"] = self.store.buckets_of(self.scope)
        self.store.read.add("documents/REPOSITORY")
        return self._lookups["buckets"]

    def documents(self, object_type: str) -> DataFrame:
        """Stored documents of this run's repositories; others are in buckets
        that are not read, or filtered."""
        return D.in_scope(self.store.documents(object_type, self.buckets), self.scope)

    def lists(self, object_type: str, field: str) -> DataFrame:
        """Stored lists in the buckets of this run's repositories. Lists of
        users belong to no repository."""
        return self.store.lists(object_type, field, None if object_type == "USER" else self.buckets)

    def sizes(self, object_type: str, field: str) -> DataFrame:
        """The same without the items, only their number."""
        return self.store.list_sizes(object_type, field, None if object_type == "USER" else self.buckets)

    def loaded(self, object_type: str, field: str) -> DataFrame:
        return reconcile.list_counts(self.sizes(object_type, field))

    @property
    def matches(self) -> DataFrame:
        """Actors by login, from all landed searches, resolved once."""
        self._used.add("user_search")
        return self._lookup("logins", lambda: actors.login_matches(self.pages("user_search")))

    @property
    def types(self) -> DataFrame:
        """Types of actors by id, from all landed pages about them."""
        self._used.add("node_type")
        return self._lookup("types", lambda: actors.actor_types(self.pages("node_type")))

    # -- running

    def prepare(self) -> None:
        """Resolve all landed actor pages; the steps do it when they need it."""
        self.refresh()
        self._lookups["logins"], self._lookups["types"] = self.matches, self.types

    def run(self) -> None:
        """All steps, over the pages that have landed when it starts. Steps
        that nothing new has come for are left out."""
        self.refresh()
        self._running, self.skipped = True, []
        try:
            for step in STEPS:
                if not self.load(step):
                    self.skipped.append(step.name)
        finally:
            self._running = False
        self.store.compact()

    def _done(self, step: Step) -> str:
        return f"{self.store.root}/steps/{self._about}/{step.name}.json"

    def _state(self, shapes: Iterable[str], tables: Iterable[str]) -> dict:
        """What a step has read: sizes of landings and contents of tables."""
        return {
            "pages": {shape: self._extent(shape) for shape in sorted(shapes)},
            "tables": {name: self.store.version(name).content for name in sorted(tables)},
        }

    def is_due(self, step: Step | str) -> bool:
        """Whether something has come for a step since it was done: pages of
        the shapes it reads, or rows of the tables it reads and does not write."""
        step = STEP_BY_NAME[step] if isinstance(step, str) else step
        done = self.store.files.read(self._done(step))
        return done is None or done != self._state(done["pages"], done["tables"])

    def load(self, step: Step | str, force: bool = False) -> bool:
        """One step; on its own, over the pages that have landed by now. Gives
        whether there was anything to do; ``force`` does it in any case."""
        if not self._running:
            self.refresh()
        step = STEP_BY_NAME[step] if isinstance(step, str) else step
        if not force and not self.is_due(step):
            return False
        self.store.forget()
        self._used = set()
        if step.name in COMMIT_SOURCES:
            self._load_commits(COMMIT_SOURCES[step.name])
        elif step.name in USER_SOURCES:
            self._load_users(USER_SOURCES[step.name])
        elif step.field in ("edits", "reactions"):
            self._load_content(step)
        else:
            getattr(self, f"_load_{step.name}")()
        read = {name for name in self.store.read - self.store.wrote if not name.startswith("pages/")}
        self.store.files.put(self._done(step), self._state(self._used, read))
        return True

    def _put_children(
        self, object_type: str, parent_type: str, field: str, children: loads.Children
    ) -> None:
        # the lists first: they are computed from parents that look incomplete
        # until the children are stored
        self.store.put_lists(parent_type, field, children.ids)
        self.store.append(object_type, children.documents)

    def _load_repositories(self) -> None:
        landed = self.pages("repository")
        self.store.replace_repositories(lambda stored: loads.repositories(landed, stored, self.wanted, self.now))
        for name in ("scope", "buckets"):
            self._lookups.pop(name, None)

    def _load_pull_requests(self) -> None:
        new = loads.pull_requests(
            self.fetched("pull_requests"),
            self.scope,
            self.store.documents("PULL_REQUEST"),
            self.matches,
        )
        self.store.append("PULL_REQUEST", new)

    def _load_pr_participants(self) -> None:
        lists = loads.participants(
            self.fetched("pr_participants"),
            self.documents("PULL_REQUEST"),
            self.loaded("PULL_REQUEST", "participants"),
            self.types,
        )
        self.store.put_lists("PULL_REQUEST", "participants", lists)

    def _load_pr_commit_ids(self) -> None:
        lists = loads.commit_ids(
            self.fetched("pr_commit_ids"),
            self.documents("PULL_REQUEST"),
            self.loaded("PULL_REQUEST", "commit_ids"),
        )
        self.store.put_lists("PULL_REQUEST", "commit_ids", lists)
        status = loads.commit_status(
            self.fetched("pr_commit_ids"),
            self.documents("PULL_REQUEST"),
            self.loaded("PULL_REQUEST", "commit_ids"),
        )
        self.store.put_late("PULL_REQUEST", "commit_id_load_status", status)

    def _load_content(self, step: Step) -> None:
        """Edits or reactions, of any type."""
        load, lookup = (
            (loads.edits, self.matches) if step.field == "edits" else (loads.reactions, self.types)
        )
        lists = load(
            self.fetched(step.shape),
            step.shape,
            self.documents(step.object_type),
            self.loaded(step.object_type, step.field),
            lookup,
        )
        self.store.put_lists(step.object_type, step.field, lists)

    def _load_pr_comments(self) -> None:
        children = loads.pr_comments(
            self.fetched("pr_comments"),
            self.documents("PULL_REQUEST"),
            self.store.documents("PULL_REQUEST_COMMENT"),
            self.matches,
        )
        self._put_children("PULL_REQUEST_COMMENT", "PULL_REQUEST", "comment_ids", children)

    def _load_reviews(self) -> None:
        children = loads.reviews(
            self.fetched("reviews"),
            self.documents("PULL_REQUEST"),
            self.store.documents("PULL_REQUEST_REVIEW"),
            self.matches,
        )
        self._put_children("PULL_REQUEST_REVIEW", "PULL_REQUEST", "review_ids", children)

    def _load_review_comments(self) -> None:
        children = loads.review_comments(
            self.fetched("review_comments"),
            self.documents("PULL_REQUEST_REVIEW"),
            self.store.documents("PULL_REQUEST_REVIEW_COMMENT"),
            self.matches,
        )
        self._put_children(
            "PULL_REQUEST_REVIEW_COMMENT", "PULL_REQUEST_REVIEW", "comment_ids", children
        )

    def _load_commits(self, source: str) -> None:
        references = loads.scoped_references(self.commit_references(source), self.scope)
        new = loads.commits(
            self.fetched("commit"), references, self.store.documents("COMMIT"), self.types
        )
        self.store.append("COMMIT", new)

    def _load_commit_pull_request_ids(self) -> None:
        lists = loads.commit_pull_request_ids(
            self.fetched("commit_pull_request_ids"),
            self.documents("COMMIT"),
            self.loaded("COMMIT", "associated_pull_request_ids"),
        )
        self.store.put_lists("COMMIT", "associated_pull_request_ids", lists)

    def _load_commit_authors(self) -> None:
        lists = loads.commit_authors(
            self.pages("commit_authors"),
            self.documents("COMMIT"),
            self.loaded("COMMIT", "authors"),
            self.types,
        )
        self.store.put_lists("COMMIT", "authors", lists)

    def _load_check_suites(self) -> None:
        children = loads.check_suites(
            self.fetched("check_suites"),
            self.documents("COMMIT"),
            self.loaded("COMMIT", "check_suite_ids"),
            self.store.documents("CHECK_SUITE"),
        )
        self._append_then_list("CHECK_SUITE", "check_suite_ids", children)

    def _load_commit_comments(self) -> None:
        children = loads.commit_comments(
            self.fetched("commit_comments"),
            self.documents("COMMIT"),
            self.loaded("COMMIT", "comment_ids"),
            self.store.documents("COMMIT_COMMENT"),
            self.matches,
        )
        self._append_then_list("COMMIT_COMMENT", "comment_ids", children)

    def _append_then_list(self, object_type: str, field: str, children: loads.Children) -> None:
        # here the list decides whether the parent is incomplete, so it is last
        self.store.append(object_type, children.documents)
        self.store.put_lists("COMMIT", field, children.ids)

    def _load_users(self, source: str) -> None:
        references = actors.distinct_ids(self.user_references(source).select("id"))
        new = loads.users(self.fetched("user"), references, self.store.documents("USER"))
        self.store.append("USER", new)

    def _load_user_organization_ids(self) -> None:
        lists = loads.user_organizations(
            self.fetched("user_organization_ids"),
            self.store.documents("USER"),
            self.loaded("USER", "organizations"),
        )
        self.store.put_lists("USER", "organizations", lists)

    def _load_organizations(self) -> None:
        new = loads.organizations(
            self.fetched("organization"),
            self.organization_references(),
            self.store.documents("ORGANIZATION"),
        )
        self.store.append("ORGANIZATION", new)

    # -- references

    def commit_references(self, source: str) -> DataFrame:
        """(repository_id, id) of the commits documents of a type refer to."""
        if source == "PULL_REQUEST":
            lists = self.lists("PULL_REQUEST", "commit_ids")
            ids = lists.select("repository_id", F.explode("items").alias("id"))
        else:
            ids = self.store.documents(source, self.buckets).select("repository_id", F.col("commit_id").alias("id"))
        return actors.distinct_ids(ids)

    def user_references(self, source: str) -> DataFrame:
        """(repository_id, id) of the users documents of a type refer to."""
        fields = [f for f in schemas.LIST_FIELDS[source] if f in _ACTOR_LISTS]
        columns = ["author", "committer"] if source == "COMMIT" else ["author"]
        references = actors.document_users(
            self.store.documents(source, self.buckets),
            {field: self.lists(source, field) for field in fields},
            columns,
            ["repository_id"],
        )
        return D.in_scope(references, self.scope)

    def organization_references(self) -> DataFrame:
        return discover.referenced_organizations(
            self.store.documents("USER"),
            self.store.lists("USER", "organizations"),
            self.store.documents("COMMIT"),
        )

    # -- reporting

    def not_found(self) -> DataFrame:
        """(kind, id): referenced commits, users and organizations the API
        answered with nothing."""
        missing = []
        for kind, shape, references in (
            ("COMMIT", "commit", [self.commit_references(s) for s in COMMIT_SOURCES.values()]),
            ("USER", "user", [self.user_references(s) for s in USER_SOURCES.values()]),
            ("ORGANIZATION", "organization", [self.organization_references()]),
        ):
            ids = reduce(DataFrame.unionAll, [r.select("id") for r in references])
            missing.append(
                loads.known_missing(ids, self.pages(shape)).select(F.lit(kind).alias("kind"), "id")
            )
        return reduce(DataFrame.unionAll, missing)

    def missing_repositories(self) -> DataFrame:
        """Wanted (owner, name) pairs that are not stored."""
        return D.repository_exists(self.store.documents("REPOSITORY"), self.wanted).filter(
            ~F.col("is_stored")
        )

    def report(self) -> DataFrame:
        """(step, repository_id, owner, name, expected, actual, ok,
        ok_recursive). A wanted repository that is not stored has an expected
        count of one in step 1 and a row without an id; what depends on all
        repositories is then not done. Global steps are reported once, without
        a repository. Every table is summed once for all the steps about it."""
        scope = self.scope
        local = [step.number for step in STEPS if step.number not in GLOBAL_STEPS]
        parts = [*self._document_sides(), *self._list_sides(), *self._open_sides()]
        report = reconcile.step_report(parts, scope, local).join(
            scope.select(F.col("id").alias("repository_id"), "owner", "name"), "repository_id"
        )
        report = report.unionByName(
            reconcile.missing_report(self.missing_repositories(), local)
        ).unionByName(self._global_report(), allowMissingColumns=True)
        return reconcile.recursive_report(self.spark, report, STEP_PARENTS, GLOBAL_STEPS)

    def _document_sides(self) -> Iterable[DataFrame]:
        """Stored documents, and what they declare."""
        scope = self.scope.select(
            F.col("id").alias("repository_id"), "total_pull_requests", F.lit(1).alias("stored")
        )
        yield reconcile.sides(
            scope, stored=[(1, "expected"), (1, "actual")], total_pull_requests=[(2, "expected")]
        )
        for object_type, number in _COUNTED_DOCUMENTS.items():
            documents = self.documents(object_type)
            declared = {
                column: [(step, "expected")]
                for step, (kind, column, _) in _DECLARED.items()
                if kind == object_type
            }
            more = {}
            targets = dict(declared)
            if number is not None:
                more["documents"] = F.lit(1)
                targets["documents"] = [(number, "actual")]
            if object_type == "PULL_REQUEST":
                field = "commit_id_load_status"
                documents = reconcile.with_loaded(
                    keyed.set_fields(documents, self.store.late(object_type, field), [field]),
                    self.loaded(object_type, "commit_ids"),
                )
                more["counted_commits"] = reconcile.counted_commits()
                targets["counted_commits"] = [(4, "actual")]
            yield reconcile.sides(
                reconcile.expected_totals(documents, *declared, **more), **targets
            )

    def _list_sides(self) -> Iterable[DataFrame]:
        """Sizes of the stored lists."""
        for step, (object_type, _, field) in _DECLARED.items():
            if field is not None:
                lists = self.sizes(object_type, field).withColumn("id", F.col("parent_id"))
                totals = reconcile.actual_list_totals(D.in_scope(lists, self.scope))
                yield reconcile.sides(totals, actual=[(step, "actual")])

    def _open_sides(self) -> Iterable[DataFrame]:
        """References still to load; expected are none. Ids that were not found
        are not open."""
        for sources, references, object_type, shape in (
            (COMMIT_SOURCES, self.commit_references, "COMMIT", "commit"),
            (USER_SOURCES, self.user_references, "USER", "user"),
        ):
            stored = self.store.documents(object_type).select("id")
            for name, source in sources.items():
                ids = D.in_scope(references(source), self.scope)
                still_open = ids.join(stored, "id", "left_anti").join(
                    loads.known_missing(ids, self.pages(shape)), "id", "left_anti"
                )
                yield reconcile.sides(
                    reconcile.actual_child_totals(still_open),
                    actual=[(STEP_BY_NAME[name].number, "actual")],
                )

    def _global_report(self) -> DataFrame:
        organizations = reconcile.global_totals(
            self.store.documents("USER"),
            "total_organizations",
            self.store.list_sizes("USER", "organizations"),
        )
        references = self.organization_references()
        still_open = discover.unsaved_count(
            references,
            self.store.documents("ORGANIZATION"),
            loads.known_missing(references, self.pages("organization")),
        ).select(F.lit(0).cast("long").alias("expected"), F.col("unsaved").alias("actual"))
        return reduce(
            DataFrame.unionByName,
            [
                totals.select(
                    F.lit(step).alias("step"),
                    F.lit(None).cast("string").alias("repository_id"),
                    "expected",
                    "actual",
                    (F.col("expected") == F.col("actual")).alias("ok"),
                )
                for step, totals in zip(GLOBAL_STEPS, (organizations, still_open))
            ],
        )


# Stored documents that a step counts, and the step (None: they only declare).
_COUNTED_DOCUMENTS = {
    "PULL_REQUEST": 2,
    "PULL_REQUEST_COMMENT": 7,
    "PULL_REQUEST_REVIEW": 10,
    "PULL_REQUEST_REVIEW_COMMENT": 13,
    "COMMIT": None,
    "COMMIT_COMMENT": None,
}

# Step -> parent type, declared total, and the list counted against it (None:
# not a list; child documents or, for commit ids, the counted commits).
_DECLARED = {
    3: ("PULL_REQUEST", "total_participants", "participants"),
    4: ("PULL_REQUEST", "total_commits", None),
    7: ("PULL_REQUEST", "total_comments", None),
    10: ("PULL_REQUEST", "total_reviews", None),
    13: ("PULL_REQUEST_REVIEW", "total_comments", None),
    19: ("COMMIT", "total_associated_pull_requests", "associated_pull_request_ids"),
    20: ("COMMIT", "total_authors", "authors"),
    21: ("COMMIT", "total_check_suites", "check_suite_ids"),
    22: ("COMMIT", "total_comments", "comment_ids"),
} | {
    step.number: (step.object_type, f"total_{step.field}", step.field)
    for step in STEPS
    if step.field in ("edits", "reactions")
}
