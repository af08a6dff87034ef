"""The shape of a nested record as a table of declarations, and the relations inside one record.

A declaration names a field by its path (`[]` for the entries of an array) and
what its value must be. Every declaration becomes column expressions, so a
record set is checked in one projection; entity, rule and field of what is
broken come out. A field is looked at where what holds it is there: a missing
parent is one violation, not one for each child.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.keys import INSTANT, INSTANT_FORM, identifier, license_filename, percent_encoded_path, safe_relative_path
from ledgerline.operators.rules import Rule, quoted


@dataclass(frozen=True)
class Field:
    """A declared field; bounds are of a text's length, an array's size or a number (least alone)."""

    path: str
    pattern: str | None = None
    values: tuple | None = None
    length: tuple[int, int] | None = None
    size: tuple[int, int] | None = None
    least: int | None = None
    unique: bool = False
    optional: bool = False
    instant: bool = False


def _reached(path: str, broken: Callable[[str, str], str]) -> str:
    """SQL: whether broken(value, holder) holds for some value at path. Where an array is on the way, for an entry of it."""

    def go(holder: str, parts: list[str], depth: int) -> str:
        name, rest = parts[0], parts[1:]
        at = f"{holder}.{name.removesuffix('[]')}" if holder else name.removesuffix("[]")
        if name.endswith("[]"):
            entry = f"x{depth}"
            return f"coalesce(exists({at}, {entry} -> {go(entry, rest, depth + 1) if rest else broken(entry, at)}), false)"
        return go(at, rest, depth) if rest else broken(at, holder or "true")

    return go("", path.split("."), 0)


def rules_of(shape: Sequence[Field]) -> list[Rule]:
    """The row rules of a shape, in its order, as SQL text: a record has more than a hundred."""
    out = []
    text = quoted

    def rule(name: str, path: str, broken: Callable[[str, str], str]) -> None:
        out.append(Rule(name, path, f"coalesce({_reached(path, lambda v, holder: f'coalesce({broken(v, holder)}, false)')}, false)"))

    for f in shape:
        if not f.optional:
            rule("required", f.path, lambda v, holder: f"{holder} is not null and {v} is null")
        if f.pattern:
            rule("pattern", f.path, lambda v, _, p=f.pattern: f"not rlike({v}, {text(f'^(?:{p})$')})")
        if f.values:
            rule("enum", f.path, lambda v, _, x=f.values: f"{v} not in ({', '.join(text(y) if isinstance(y, str) else str(y) for y in x)})")
        if f.length:
            rule("length", f.path, lambda v, _, x=f.length: f"char_length({v}) not between {x[0]} and {x[1]}")
        if f.size:
            rule("size", f.path, lambda v, _, x=f.size: f"size({v}) not between {x[0]} and {x[1]}")
        if f.least is not None:
            rule("minimum", f.path, lambda v, _, x=f.least: f"{v} < {x}")
        if f.unique:
            rule("unique", f.path, lambda v, _: f"size(array_distinct({v})) < size({v})")
        if f.instant:
            rule("instant", f.path, lambda v, _: f"not coalesce(rlike({v}, {text(INSTANT)}) and try_to_timestamp({v}, {text(INSTANT_FORM)}) is not null, false)")
    return out


#: The forms and bounds of a record's fields.
COMMIT, DIGEST, REPOSITORY, LOGIN, ORCID = "[0-9a-f]{40}", "[0-9a-f]{64}", "[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+", "[A-Za-z0-9](?:[A-Za-z0-9-]{0,37}[A-Za-z0-9])?", "[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9X]{4}"
PLAIN = r"(?s)[^\x00-\x08\x0b\x0c\x0e-\x1f\x7f]*"
ARXIV, MSC, SUBMISSION = r"[a-z]+(?:-[a-z]+)*(?:\.[A-Za-z-]+)?", "[0-9]{2}(?:[A-Z][0-9]{2}|-[0-9]{2})", "[0-9a-z]{12}"
MANY = 2_147_483_647


def _people(path: str, least: int = 1) -> list[Field]:
    return [Field(path, size=(least, MANY)), Field(f"{path}[].name", length=(1, MANY)), Field(f"{path}[].github", pattern=LOGIN, optional=True), Field(f"{path}[].orcid", pattern=ORCID, optional=True)]


def record_shape(prefix: str, host: str, archive: str) -> list[Field]:
    """The declared fields of a record version. prefix is that of its identifiers, host where repositories live, archive who keeps copies."""
    version = f"{identifier(prefix)}-v[1-9][0-9]*"
    paths = ("challenge_path", "solution_path", "comparator_config_path", "formalization_metadata_path", "lakefile_path")
    tools = ("comparator_commit", "lean4export_commit", "landrun_commit", "nanoda_commit", "workflow_commit")
    return [
        Field("schema_version", values=(3,)), Field("id", pattern=identifier(prefix)), Field("first_registered_on", pattern="[0-9]{4}-[0-9]{2}-[0-9]{2}"), Field("registered_at", instant=True),
        Field("version", least=1), Field("status", values=("registered",)), Field("title", length=(1, 300), pattern=PLAIN), Field("abstract", length=(1, 10_000), pattern=PLAIN), *_people("authors"),
        Field("classification.arxiv", size=(1, 2), unique=True), Field("classification.arxiv[]", pattern=ARXIV), Field("classification.msc2020", size=(1, 8), unique=True), Field("classification.msc2020[]", pattern=MSC),
        Field("provenance.result_origin", values=("original", "source-based")), Field("provenance.repository_role", values=("substantive-development", "thin-wrapper")), *_people("provenance.responsible_maintainers"),
        Field("provenance.substantive_formalization.repository", pattern=REPOSITORY), Field("provenance.substantive_formalization.repository_url", pattern=f"{host}.*"), Field("provenance.substantive_formalization.commit", pattern=COMMIT), Field("provenance.substantive_formalization.tree_url", pattern=f"{host}.+/tree/{COMMIT}"),
        Field("provenance.mathematical_sources"), Field("provenance.mathematical_sources[].title", length=(1, 10_000)), *_people("provenance.mathematical_sources[].authors", 0),
        Field("provenance.mathematical_sources[].relationship", values=("formalizes", "adapts", "independently-proves", "background", "other")),
        *[Field(f"provenance.mathematical_sources[].{name}", length=(1, most), optional=True) for name, most in (("identifier", 2048), ("type", 200), ("location", 1000), ("license", 500))],
        Field("provenance.mathematical_sources[].author_endorsement", values=("participated", "endorsed", "no-response", "not-contacted", "declined", "n/a"), optional=True),
        Field("provenance.related_formalizations"), Field("provenance.related_formalizations[].identifier", length=(1, 2048)), Field("provenance.related_formalizations[].relationship", values=("builds-on", "adapts", "independent", "supersedes", "other")), Field("provenance.related_formalizations[].note", length=(1, 10_000), optional=True),
        Field("source.repository", pattern=REPOSITORY), Field("source.repository_url", pattern=f"{host}.*"), Field("source.commit", pattern=COMMIT), Field("source.tree_url", pattern=f"{host}.+/tree/{COMMIT}(?:/.+)?"), Field("source.project_path", length=(1, 4096), optional=True),
        Field("source.license.path", length=(1, 64), pattern=r"[^/\\]+"), Field("source.license.sha256", pattern=DIGEST), Field("source.license.declared_identifier", length=(1, 200)), Field("source.license.detected_identifier", length=(1, 200)),
        Field("preservation.archive_owner", values=(archive,)), Field("preservation.archived_at", instant=True), Field("preservation.receipt_sha256", pattern=DIGEST), Field("preservation.repositories", size=(1, MANY)),
        Field("preservation.repositories[].source_repository", pattern=REPOSITORY), Field("preservation.repositories[].commit", pattern=COMMIT), Field("preservation.repositories[].fork_repository", pattern=f"{archive}/[A-Za-z0-9_.-]+"), Field("preservation.repositories[].ref", pattern=f"refs/tags/[a-z]+/{version}/{COMMIT}"),
        Field("formalization.lean_toolchain", pattern="leanprover/lean4:.*"), *[Field(f"formalization.{p}", length=(1, 4096)) for p in paths],
        Field("formalization.project_dependencies"), Field("formalization.project_dependencies[].name", length=(1, MANY)), Field("formalization.project_dependencies[].repository", pattern=REPOSITORY, optional=True), Field("formalization.project_dependencies[].revision", pattern=COMMIT, optional=True), Field("formalization.project_dependencies[].path", length=(1, 4096), optional=True),
        Field("formalization.theorem_names", size=(1, MANY), unique=True), Field("formalization.theorem_names[]", length=(1, MANY)), Field("formalization.definition_names", unique=True), Field("formalization.definition_names[]", length=(1, MANY)),
        Field("formalization.permitted_axioms", unique=True), Field("formalization.permitted_axioms[]", values=("propext", "Quot.sound", "Classical.choice")),
        Field("verification.verified_at", instant=True), Field("verification.workflow_url"), *[Field(f"verification.{c}", pattern=COMMIT) for c in tools], Field("verification.workflow_run_attempt", least=1), Field("verification.run_id", least=1), Field("verification.repository"), Field("verification.workflow_path"),
        Field("verification.evidence_path", pattern=f"evidence/{version}/{DIGEST}/"), *[Field(f"verification.{c}", pattern=DIGEST) for c in ("evidence_tree_sha256", "mechanical_report_sha256", "challenge_sha256", "solution_sha256")],
        Field("challenge_render.format", values=("verso-html",)), Field("challenge_render.artifact_path", pattern=f"renders/{version}/{DIGEST}/"), Field("challenge_render.entrypoint", values=("Challenge/index.html",)), Field("challenge_render.artifact_tree_sha256", pattern=DIGEST),
        *[Field(f"challenge_render.{c}", pattern=COMMIT) for c in ("verso_commit", "renderer_commit", "landrun_commit")], Field("challenge_render.rendered_at", instant=True),
        Field("review.reviewed_at", instant=True), Field("review.policy_commit", pattern=COMMIT), Field("review.outcome", values=("neutral",)), Field("review.reviewer_models", size=(1, MANY), unique=True), Field("review.reviewer_models[]", length=(1, MANY)),
        Field("review.warnings", size=(0, 100)), Field("review.warnings[]", length=(1, 2000), pattern=PLAIN), Field("review.report.sha256", pattern=DIGEST),
        Field("trust.level", values=("high", "qualified")), Field("trust.challenge_lines", least=1), Field("trust.challenge_bytes", least=1), Field("trust.challenge_imports", unique=True), Field("trust.challenge_imports[]", length=(1, MANY)),
        Field("trust.challenge_dependencies", unique=True), Field("trust.challenge_dependencies[].repository", pattern=REPOSITORY), Field("trust.challenge_dependencies[].provenance", values=("allowlisted",)), Field("trust.reasons", size=(0, 100)), Field("trust.reasons[]", length=(1, 2000), pattern=PLAIN),
        Field("submission.submission_id", pattern=SUBMISSION), Field("submission.authorization.relationship", values=("maintainer", "approved")), Field("submission.authorization.evidence", length=(1, 2000), pattern=PLAIN, optional=True),
    ]


def holder_rules(holders: Sequence[str]) -> list[Rule]:
    """Nested objects that must be there at all."""
    return [Rule("required", h, F.col(h).isNull()) for h in holders]


#: Objects that every record has.
HOLDERS = ("classification", "provenance", "source", "source.license", "preservation", "formalization", "verification", "challenge_render", "review", "review.report", "trust", "submission", "submission.authorization")


def _some(entries: Column, holds: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(entries, holds), F.lit(False))


def conditional_rules() -> list[Rule]:
    """What a record's own values ask of others: cited sources of a source-based result, those of an original one, a thin wrapper's upstream, and a dependency's one of two forms."""
    sources, origin = F.col("provenance.mathematical_sources"), F.col("provenance.result_origin")
    cites = _some(sources, lambda s: s["relationship"].isin("formalizes", "adapts", "independently-proves"))
    loose = _some(sources, lambda s: ~s["relationship"].isin("background", "other"))
    one_form = lambda d: (d["repository"].isNotNull() & d["revision"].isNotNull() & d["path"].isNull()) | (d["repository"].isNull() & d["revision"].isNull() & d["path"].isNotNull())
    return [
        Rule("conditional", "provenance.mathematical_sources", (origin == "source-based") & ~cites),
        Rule("conditional", "provenance.mathematical_sources", (origin == "original") & loose),
        Rule("conditional", "provenance.substantive_formalization", (F.col("provenance.repository_role") == "thin-wrapper") & F.col("provenance.substantive_formalization").isNull()),
        Rule("either", "formalization.project_dependencies", _some(F.col("formalization.project_dependencies"), lambda d: ~one_form(d))),
    ]


def _differs(actual: Column, expected: Column) -> Column:
    return ~actual.eqNullSafe(expected)


def path_rules() -> list[Rule]:
    """Paths are safe, inside the project where there is one, and the build file is one of two at its root."""
    project = F.col("source.project_path")
    rules = [Rule("safe", "source.project_path", project.isNotNull() & ~safe_relative_path(project))]
    for name in ("challenge_path", "solution_path", "comparator_config_path", "formalization_metadata_path", "lakefile_path"):
        rules.append(Rule("safe", f"formalization.{name}", ~safe_relative_path(F.col(f"formalization.{name}"))))
        if name != "formalization_metadata_path":
            rules.append(Rule("inside", f"formalization.{name}", project.isNotNull() & ~F.col(f"formalization.{name}").startswith(F.concat(project, F.lit("/")))))
    root = F.coalesce(F.concat(project, F.lit("/")), F.lit(""))
    named = F.col("formalization.lakefile_path").isin(F.concat(root, F.lit("lakefile.toml")), F.concat(root, F.lit("lakefile.lean")))
    return [*rules, Rule("build file", "formalization.lakefile_path", ~named)]


def url_rules(host: str) -> list[Rule]:
    """URLs that follow from other fields are what they must be."""
    base = lambda c: F.concat(F.lit(host), c)
    tree = lambda repository, commit: F.concat(base(repository), F.lit("/tree/"), commit)
    tail = F.coalesce(F.concat(F.lit("/"), percent_encoded_path(F.col("source.project_path"))), F.lit(""))
    upstream = "provenance.substantive_formalization"
    there = F.col(upstream).isNotNull()
    return [
        Rule("derived", "source.repository_url", _differs(F.col("source.repository_url"), base(F.col("source.repository")))),
        Rule("derived", "source.tree_url", _differs(F.col("source.tree_url"), F.concat(tree(F.col("source.repository"), F.col("source.commit")), tail))),
        Rule("derived", f"{upstream}.repository_url", there & _differs(F.col(f"{upstream}.repository_url"), base(F.col(f"{upstream}.repository")))),
        Rule("derived", f"{upstream}.tree_url", there & _differs(F.col(f"{upstream}.tree_url"), tree(F.col(f"{upstream}.repository"), F.col(f"{upstream}.commit")))),
        Rule("derived", "verification.workflow_url", _differs(F.col("verification.workflow_url"), F.concat(base(F.col("verification.repository")), F.lit("/actions/runs/"), F.col("verification.run_id").cast("string")))),
    ]


def license_rules() -> list[Rule]:
    return [
        Rule("name", "source.license.path", ~license_filename(F.col("source.license.path"))),
        Rule("declared", "source.license", F.col("source.license.declared_identifier") != F.col("source.license.detected_identifier")),
    ]


def canonical(repository: Column, aliases: dict[str, str]) -> Column:
    """A repository in lower case, under the name that it has now."""
    low = F.lower(repository)
    if not aliases:
        return low
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]), low), low)


def dependency_rules(trusted: Sequence[str], aliases: dict[str, str]) -> list[Rule]:
    """Names, paths and challenge repositories once each; challenge dependencies among the project's; high trust needs trusted ones alone; retired provenance refused."""
    own, asked = F.col("formalization.project_dependencies"), F.col("trust.challenge_dependencies")
    repeated = lambda values: F.size(F.array_compact(values)) > F.size(F.array_distinct(F.array_compact(values)))
    name = lambda d: canonical(d["repository"], aliases)
    known = F.array_compact(F.transform(own, name))
    return [
        Rule("unique", "formalization.project_dependencies.name", F.coalesce(repeated(F.transform(own, lambda d: d["name"])), F.lit(False))),
        Rule("unique", "formalization.project_dependencies.path", F.coalesce(repeated(F.transform(own, lambda d: d["path"])), F.lit(False))),
        Rule("safe", "formalization.project_dependencies.path", _some(own, lambda d: d["path"].isNotNull() & ~safe_relative_path(d["path"], allow_dot=True))),
        Rule("unique", "trust.challenge_dependencies.repository", F.coalesce(repeated(F.transform(asked, name)), F.lit(False))),
        Rule("known", "trust.challenge_dependencies.repository", F.coalesce(F.size(F.array_except(F.array_compact(F.transform(asked, name)), known)) > 0, F.lit(False))),
        Rule("trust", "trust.level", (F.col("trust.level") == "high") & _some(asked, lambda d: (d["provenance"] == "allowlisted") & ~name(d).isin(*[t.lower() for t in trusted]))),
        Rule("retired", "trust.challenge_dependencies.provenance", _some(asked, lambda d: d["provenance"].isNotNull() & (d["provenance"] != "allowlisted"))),
    ]


def preservation_rules(archive: str, ref: str) -> list[Rule]:
    """Mappings cover the source, the dependencies in repositories and the upstream exactly, once and in order; refs and owners are as they must be. ref is what a ref begins with."""
    mapped, dependencies, upstream = F.col("preservation.repositories"), F.col("formalization.project_dependencies"), F.col("provenance.substantive_formalization")
    at = lambda repository, commit: F.struct(F.lower(repository).alias("low"), commit.alias("commit"), repository.alias("repository"))
    needed = F.concat(
        F.array(at(F.col("source.repository"), F.col("source.commit"))),
        F.coalesce(F.transform(F.filter(dependencies, lambda d: d["repository"].isNotNull()), lambda d: at(d["repository"], d["revision"])), F.array()),
        F.when(upstream.isNotNull(), F.array(at(upstream["repository"], upstream["commit"]))).otherwise(F.array()),
    )
    # Of spellings that differ in case alone, the first stands for the source.
    keys = F.array_distinct(F.transform(needed, lambda x: F.struct(x["low"].alias("low"), x["commit"].alias("commit"))))
    spelled = F.transform(F.array_sort(keys), lambda k: F.get(F.filter(needed, lambda x: (x["low"] == k["low"]) & (x["commit"] == k["commit"])), 0))
    pairs = lambda xs, r: F.transform(xs, lambda x: F.struct(x[r].alias("repository"), x["commit"].alias("commit")))
    folded = F.transform(mapped, lambda m: F.struct(F.lower(m["source_repository"]).alias("low"), m["commit"].alias("commit")))
    expected = lambda m: F.concat(F.lit(ref), F.col("id"), F.lit("-v"), F.col("version").cast("string"), F.lit("/"), m["commit"])
    return [
        Rule("cover", "preservation.repositories", _differs(pairs(mapped, "source_repository"), pairs(spelled, "repository"))),
        Rule("unique", "preservation.repositories", F.size(folded) > F.size(F.array_distinct(folded))),
        Rule("ref", "preservation.repositories.ref", _some(mapped, lambda m: _differs(m["ref"], expected(m)))),
        Rule("owner", "preservation.repositories.fork_repository", _some(mapped, lambda m: ~m["fork_repository"].startswith(f"{archive}/"))),
    ]


def key_rules(prefix: str) -> list[Rule]:
    """A record's file is named by its key, and its identifier's day is that of the first registration."""
    day = F.regexp_extract("id", rf"^{prefix}-([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})-[0-9]{{6}}$", 1)
    return [
        Rule("file name", "file", _differs(F.col("file"), F.concat("id", F.lit("-v"), F.col("version").cast("string"), F.lit(".json")))),
        Rule("first day", "id", day != F.col("first_registered_on")),
    ]


def score_shape(prefix: str) -> list[Field]:
    """The declared fields of a record's score."""
    marks = ("statement_alignment", "definition_fidelity", "notability", "literature", "clarity")
    return [Field("schema_version", values=(1,)), Field("id", pattern=identifier(prefix)), Field("version", least=1), Field("reviewed_at", instant=True), Field("policy_commit", pattern=COMMIT), *[Field(f"scores.{m}", least=0) for m in marks]]


#: The keys of the registry's own documents.
AUTHORITY_KEYS = {
    "result": ("schema_version", "id", "first_registered_on", "identity", "versions"),
    "submission": ("schema_version", "submission_id", "id", "version", "entry_path"),
    "day": ("schema_version", "date", "last_serial"),
    "identity": ("schema_version", "identity", "registration_id"),
}
