"""Structured documents: master records, Markdown sections, rendered texts and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thicket.functions import text as text_functions
from thicket.functions.text import canonical_doc_id, spanish_date
from thicket.session import stored

SEPARATOR = "@"
NUMBER = r"(?:\.|-\.|\.-)?"
# The heading grammar, sections 1-10 and at most 15 subsections of each.
SECTION_PATTERNS = (rf"^\*\*(\d+){NUMBER}\*\*[\s.]*(?:-?\s*)(.*?)$", rf"^\*\*(\d+){NUMBER}\s+(?:-?\s*)(.*?)\*\*$", rf"^(\d+){NUMBER}\s+\*\*(.*?)\*\*$")
SUBSECTION_PATTERNS = (rf"^\*\*(\d+\.\d+){NUMBER}\*\*[\s.]*(?:-?\s*)(.*?)$", rf"^\*\*(\d+\.\d+){NUMBER}\s+(?:-?\s*)(.*?)\*\*$")
PLAIN_SUBSECTION = rf"^(\d+\.\d+){NUMBER}\s*(?:-\s*)?(.*?)$"
# How the target species read in running text; up to the next line that starts with a digit.
FREE_SPECIES = (r"(?i)especies?(?:\s+de)?\s+destino[:\s]*([^\n]*(?:\n[^\n]*)*?)(?=\n\d|$(?!\n))", r"(?i)\d+\.\d+\.?\s+especies?(?:\s+de)?\s+destino\s*([^\n]*(?:\n[^\n]*)*?)(?=\n\d|$(?!\n))")
UNIT = r"^(mg|ml|g|kg|l|%|µg|mcg|ui)\b"


def latest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """Last write wins: the row of each key that comes first in the given (descending) order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_nth = 1").drop("_nth")


def _first(line: Column, patterns: tuple[str, ...], group: int) -> Column:
    return F.coalesce(*[F.when(F.rlike(line, F.lit(p)), F.regexp_extract(line, p, group)) for p in patterns])


def _found(lines: Column, strict: bool) -> Column:
    """The headings among lines: (at, size, kind, id, parent, title), at the line's number from 0, size its characters."""
    numbers = [str(n) for n in range(1, 11)]

    def read(c: Column) -> Column:
        line = c["line"]
        bare = F.trim(F.regexp_replace(line, r"\*\*", ""))
        plain = F.when(F.rlike(bare, F.lit(PLAIN_SUBSECTION)), F.struct(F.regexp_extract(bare, PLAIN_SUBSECTION, 1).alias("id"), F.regexp_extract(bare, PLAIN_SUBSECTION, 2).alias("title")))
        return F.struct(c["at"].alias("at"), line.alias("line"), _first(line, SECTION_PATTERNS, 1).alias("section"), _first(line, SUBSECTION_PATTERNS, 1).alias("bold"), plain.alias("plain"))

    def told(h: Column) -> Column:
        plain, line = h["plain"], h["line"]
        if strict:
            titled = F.lower(F.trim(plain["title"]))
            plain_id = F.when((titled != "") & ~F.rlike(titled, F.lit(UNIT)), plain["id"])
        else:
            plain_id = plain["id"]
        title = F.when(h["section"].isNotNull(), _first(line, SECTION_PATTERNS, 2)).otherwise(F.coalesce(_first(line, SUBSECTION_PATTERNS, 2), plain["title"]))
        ident = F.coalesce(h["section"], h["bold"], plain_id)
        return F.struct(
            h["at"].alias("at"), F.length(line).alias("size"), F.when(h["section"].isNotNull(), "section").otherwise("subsection").alias("kind"), ident.alias("id"),
            F.when(h["section"].isNull(), F.substring_index(ident, ".", 1)).alias("parent"), F.trim(F.regexp_replace(F.trim(F.regexp_replace(title, r"\*\*", "")), ":$", "")).alias("title"),
        )

    # A heading has nothing but asterisks and spaces before its number, so the grammar is tried on few lines.
    few = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("at"), line.alias("line"))), lambda c: F.rlike(c["line"], F.lit(r"^[ *]*\d")))
    valid = lambda h: F.when(h["kind"] == "section", h["id"].isin(numbers)).otherwise(h["parent"].isin(numbers) & (F.substring_index(h["id"], ".", -1).cast("int") <= 15))
    return F.filter(F.transform(F.transform(few, read), told), lambda h: h["id"].isNotNull() & valid(h))


def _lines(text: Column | str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def headings(docs: DataFrame, key: str = "document_id", text: str = "text", strict: bool = False) -> DataFrame:
    """(key, kind, id, parent, title, start, end): heading lines with offsets into the text, kind 'section' or 'subsection'.

    strict=False also takes any line that starts with a decimal number as a
    subsection, 'body' lines such as '2.5 ml' included; strict needs bold or a
    title that is no unit.  Each row is a document and is read where it lies.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def placed(c: Column) -> Column:
        """Offsets from the sums of groups of lines, so that a text of n lines takes about n * sqrt(n) steps at most."""
        sizes, width = c["sizes"], c["width"]
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / width).cast("int")), lambda k: total(F.slice(sizes, k * width + 1, width)))
        group = lambda at: F.floor(at / width).cast("int")
        start = lambda before, at: F.get(before, group(at)) + total(F.slice(sizes, group(at) * width + 1, at - group(at) * width))
        before = text_functions.let(sums, lambda s: F.transform(s, lambda _, k: total(F.slice(s, F.lit(1), k))))
        return text_functions.let(before, lambda b: F.transform(c["found"], lambda h: F.struct(h["kind"].alias("kind"), h["id"].alias("id"), h["parent"].alias("parent"), h["title"].alias("title"), start(b, h["at"]).alias("start"), (start(b, h["at"]) + h["size"]).alias("end"))))

    each = text_functions.let(_lines(text), lambda lines: text_functions.let(F.struct(_found(lines, strict).alias("found"), F.transform(lines, lambda x: F.length(x) + 1).alias("sizes"), F.ceil(F.sqrt(F.size(lines))).cast("int").alias("width")), placed))
    return docs.select(key, F.inline(each))


def parsed_sections(text: Column | str, strict: bool = False) -> Column:
    """Array of (kind, id, parent, title, content) of a text: the last heading of an id wins, with the text up to the next heading.

    A section ends at the next section; with subsections it keeps the text
    before its first one.  A subsection ends at the next heading of its parent
    or the next section.  A subsection whose parent never appears gets a
    section 'SECCIÓN n' without content.
    """

    def rows(c: Column) -> Column:
        lines, found, keys, marks = c["lines"], c["found"], c["keys"], c["marks"]
        many = F.size(found)
        ahead = lambda a, values, x: F.array_position(F.slice(values, a + 2, many), x).cast("int")  # noqa: E731  how far on x comes next; 0 for never

        def item(x: Column) -> Column:
            h, a = x["h"], x["a"]
            step = F.when(h["kind"] == "section", F.lit(1)).otherwise(ahead(a, F.get(marks, h["parent"].cast("int") - 1), 1))
            stop = F.when(step == 0, F.size(lines)).otherwise(F.coalesce(F.get(found, a + step)["at"], F.size(lines)))
            body = F.array_join(F.slice(lines, h["at"] + 2, stop - h["at"] - 1), "\n")
            return F.struct(h["kind"].alias("kind"), h["id"].alias("id"), h["parent"].alias("parent"), h["title"].alias("title"), F.regexp_replace(body, r"^\s+|\s+$", "").alias("content"))

        last = F.filter(F.transform(found, lambda h, a: F.struct(h.alias("h"), a.alias("a"))), lambda x: ahead(x["a"], keys, F.get(keys, x["a"])) == 0)
        return F.transform(last, item)

    def with_made(found: Column) -> Column:
        of = lambda kind, name: F.transform(F.filter(found, lambda h: h["kind"] == kind), lambda h: h[name])
        orphans = F.array_except(of("subsection", "parent"), of("section", "id"))
        return F.concat(found, F.transform(orphans, lambda n: F.struct(F.lit("section").alias("kind"), n.alias("id"), F.lit(None).cast("string").alias("parent"), F.concat(F.lit("SECCIÓN "), n).alias("title"), F.lit("").alias("content"))))

    def indexed(c: Column) -> Column:
        found = c["found"]
        marks = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda n: F.transform(found, lambda h: F.when((h["kind"] == "section") | (h["parent"] == n.cast("string")), 1).otherwise(0)))
        return F.struct(c["lines"].alias("lines"), found.alias("found"), F.transform(found, lambda h: F.concat(h["kind"], h["id"])).alias("keys"), marks.alias("marks"))

    let = text_functions.let
    return let(let(let(let(_lines(text), lambda lines: F.struct(lines.alias("lines"), _found(lines, strict).alias("found"))), indexed), rows), with_made)


def section_rows(docs: DataFrame, key: str = "document_id", text: str = "text", strict: bool = False) -> DataFrame:
    """(key, kind, id, parent, title, content): parsed_sections() of every row, without a shuffle."""
    return docs.select(key, F.inline(parsed_sections(text, strict)))


def section_tree(rows: Column) -> Column:
    """Of parsed_sections(): sections by number, each with its subsections by dotted number."""
    number = lambda c: F.transform(F.split(c, r"\."), lambda x: x.cast("int"))
    named = lambda x: [x["id"].alias("seccion_id"), x["title"].alias("titulo"), x["content"].alias("contenido")]

    def tree(all_: Column) -> Column:
        subs = lambda s: F.array_sort(F.transform(F.filter(all_, lambda x: x["parent"] == s["id"]), lambda x: F.struct(number(x["id"]).alias("n"), *named(x))))
        clean = lambda s: F.transform(subs(s), lambda x: F.struct(x["seccion_id"], x["titulo"], x["contenido"]))
        top = F.transform(F.filter(all_, lambda x: x["kind"] == "section"), lambda s: F.struct(s["id"].cast("int").alias("n"), *named(s), clean(s).alias("subsecciones")))
        return F.transform(F.array_sort(top), lambda s: F.struct(s["seccion_id"], s["titulo"], s["contenido"], s["subsecciones"]))

    return text_functions.let(rows, tree)


def section_trees(docs: DataFrame, key: str = "document_id", text: str = "text", strict: bool = False) -> DataFrame:
    """(key, secciones) of every document with a section."""
    return docs.select(key, section_tree(parsed_sections(text, strict)).alias("secciones")).filter(F.size("secciones") > 0)


def trim_after_last_section(text: Column) -> Column:
    """The text up to the first '-----' after the heading of section 10, whole without one."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(?s)^(.*?\n\*{0,2}10\.(?!\d).*?)-----", 1), F.lit("")), text)


def clean_species(content: Column) -> Column:
    """The first line; over 50 characters its first sentence; one closing punctuation mark dropped."""
    line = F.trim(F.get(F.split(content, "\n"), F.lit(0)))
    line = F.when(F.length(line) > 50, F.trim(F.get(F.split(line, r"\."), F.lit(0)))).otherwise(line)
    return F.trim(F.regexp_replace(line, r"[.,;:()\[\]]$", ""))


def target_species(rows: DataFrame, docs: DataFrame, key: str = "document_id", text: str = "text") -> DataFrame:
    """(key, especies_destino): from 3.1, else any subsection so titled, else free text."""
    title = F.lower("title")
    named = F.contains(title, F.lit("especie")) & F.contains(title, F.lit("destino"))
    subs = rows.filter("kind = 'subsection'").filter(named).groupBy(key).agg(F.max(F.when(F.col("id") == "3.1", F.col("content"))).alias("a"), F.min_by("content", F.transform(F.split("id", r"\."), lambda x: x.cast("int"))).alias("b"))
    free = F.coalesce(*[F.nullif(F.trim(F.regexp_extract(F.col(text), p, 1)), F.lit("")) for p in FREE_SPECIES])
    return docs.join(subs, key, "left").select(key, F.coalesce(clean_species(F.coalesce("a", "b", free)), F.lit("")).alias("especies_destino"))


def reshape_for_model(master: DataFrame) -> DataFrame:
    """Master records for a language model: names instead of structs, indications by species ('All' without one)."""
    names = lambda c: F.transform(F.coalesce(c, F.array().cast("array<struct<nombre:string>>")), lambda x: x["nombre"])
    species = F.array_distinct(F.transform("metadata.indicaciones", lambda x: F.coalesce(x["especie"]["nombre"], F.lit("All"))))
    grouped = F.map_from_arrays(species, F.transform(species, lambda s: F.transform(F.filter("metadata.indicaciones", lambda x: F.coalesce(x["especie"]["nombre"], F.lit("All")) == s), lambda x: x["nombre"])))
    return master.select(
        "nregistro", "nombre", F.when(F.size("antibiotico") > 0, F.to_json("antibiotico")).otherwise("No").alias("antibiotico"),
        F.transform("metadata.principiosActivos", lambda x: x["nombre"]).alias("active_substances"), F.transform("metadata.especies", lambda x: x["nombre"]).alias("especies"),
        F.transform("metadata.viasAdministracion", lambda x: x["nombre"]).alias("ruta_administracion"), F.when(F.col("metadata.indicaciones").isNotNull(), grouped).alias("indicaciones"),
    )


def antibiotic_details(master: DataFrame, lookup: DataFrame) -> DataFrame:
    """(nregistro, antibiotico array, is_antibiotic): codes of flagged records that the lookup knows, in record order."""
    flagged = master.filter("is_antibiotic").select("nregistro", F.posexplode("principios").alias("at", "codigo"))
    first = latest(lookup, "COD_PACTIV", F.asc("position"))
    found = flagged.join(first, flagged["codigo"] == first["COD_PACTIV"]).groupBy("nregistro").agg(F.array_sort(F.collect_list(F.struct("at", F.col("Categoría").alias("categoria"), F.col("Familia").alias("familia"), F.col("Principio activo").alias("principio")))).alias("_d"))
    details = F.transform("_d", lambda d: F.struct(d["categoria"].alias("categoria"), d["familia"].alias("familia"), d["principio"].alias("principio")))
    return master.join(found, "nregistro", "left").select("nregistro", F.coalesce(details, F.array().cast("array<struct<categoria:string,familia:string,principio:string>>")).alias("antibiotico"), F.coalesce("is_antibiotic", F.lit(False)).alias("is_antibiotic"))


def names_of(array: str) -> Column:
    return F.array_join(F.filter(F.transform(array, lambda x: x["nombre"]), lambda n: F.coalesce(n, F.lit("")) != ""), ", ")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _blank(c: Column) -> Column:
    return _text(c) == ""


def species_name(x: Column, default: str = "") -> Column:
    """The normalised name of a struct's species, else its name."""
    return F.coalesce(x["especie"]["nombre_normalizado"], x["especie"]["nombre"], F.lit(default))


def _in_groups(array: str | Column, key, item, block, sep: str = "") -> Column:
    """block(key, items) of each key in order of first sight, joined; '' for an empty array."""
    array = F.col(array) if isinstance(array, str) else array
    keys = F.array_distinct(F.transform(array, key))
    return _text(F.array_join(F.transform(keys, lambda k: block(k, F.transform(F.filter(array, lambda x: key(x) == k), item))), sep))


def essential_text(docs: DataFrame) -> DataFrame:
    """(document_id, essential): the labelled parts of a structured document; all but the first four and the antibiotic one are left out when blank."""
    part = lambda label, value: F.when(~_blank(value), F.concat(F.lit(f"{label}: "), value))
    always = lambda label, value: F.concat(F.lit(f"{label}: "), _text(value))
    both = lambda s: F.when(~_blank(s["nombre"]) & ~_blank(s["nombre_normalizado"]) & (F.lower(s["nombre"]) != F.lower(s["nombre_normalizado"])), F.concat(s["nombre"], F.lit(" ("), s["nombre_normalizado"], F.lit(")"))).otherwise(F.coalesce(F.nullif(s["nombre_normalizado"], F.lit("")), s["nombre"]))
    species = F.when(F.size("especies_registro") > 0, F.array_join(F.transform("especies_registro", both), ", ")).otherwise(F.col("especies_destino"))
    atc = F.array_join(F.transform(F.filter("codigos_atc", lambda a: ~_blank(a["codigo"]) & ~_blank(a["nombre"])), lambda a: F.concat(a["codigo"], F.lit(": "), a["nombre"], F.lit(" (Nivel "), _text(a["nivel"].cast("string")), F.lit(")"))), "; ")
    amount = lambda p: F.when(~_blank(p["cantidad"]) & ~_blank(p["unidad"]), F.concat(p["nombre"], F.lit(" ("), p["cantidad"], F.lit(" "), p["unidad"], F.lit(")"))).otherwise(p["nombre"])
    actives = F.when(F.size("principios_activos_registro") > 0, F.array_join(F.transform(F.filter("principios_activos_registro", lambda p: ~_blank(p["nombre"])), amount), "; ")).otherwise(F.col("principios_activos"))
    named = lambda array: F.filter(array, lambda x: ~_blank(x["nombre"]))
    indications = _in_groups(named("indicaciones"), lambda x: species_name(x, "General"), lambda x: x["nombre"], lambda k, all_: F.array_join(F.transform(all_, lambda n: F.concat(n, F.lit(" ("), k, F.lit(")"))), "; "), "; ")
    is_species = lambda x: F.coalesce(x["es_especie"], F.lit(False))
    contra = F.array_join(F.transform(F.filter(named("contraindicaciones"), lambda x: ~is_species(x)), lambda x: F.when(x["especie"].isNotNull(), F.concat(x["nombre"], F.lit(" ("), species_name(x), F.lit(")"))).otherwise(x["nombre"])), "; ")
    never = F.array_join(F.filter(F.transform(F.filter("contraindicaciones", is_species), lambda x: F.coalesce(x["nombre_normalizado"], x["nombre"])), lambda n: ~_blank(n)), ", ")
    avoid = F.concat_ws(". ", F.when(~_blank(contra), F.concat(F.lit("Contraindicaciones: "), contra)), F.when(~_blank(never), F.concat(F.lit("No usar en: "), never)))
    parts = [
        always("ID", F.col("document_id")), always("Medicamento", F.col("nombre_medicamento")), always("Laboratorio", F.col("laboratorio_titular")), always("Autorización", F.col("fecha_primera_autorizacion")),
        part("Especies", species), part("Códigos ATC", atc), part("Principios activos", actives), part("Forma farmacéutica", F.col("forma_farmaceutica")),
        part("Vías de administración", names_of("vias_administracion")), always("Antibiótico", F.when(F.coalesce("es_antibiotico", F.lit(False)), "Sí").otherwise("No")),
        part("Indicaciones", indications), F.nullif(avoid, F.lit("")), part("Dispensación", F.col("condiciones_dispensacion")), part("Administración", F.col("condiciones_administracion")),
    ]
    return docs.select("document_id", F.concat_ws("\n", *parts).alias("essential"))


def species_text(docs: DataFrame) -> Column:
    """Normalised names of the registered species, else the parsed text."""
    return F.when(F.size("especies_registro") > 0, F.array_join(F.transform("especies_registro", lambda s: F.coalesce(s["nombre_normalizado"], s["nombre"], F.lit(""))), ", ")).otherwise(_text(F.col("especies_destino")))


def with_essential_text(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(document_id, essential, made): texts(document_id, essential) of the documents, six plain lines where there is none."""
    line = lambda label, c: F.concat(F.lit(f"{label}: "), _text(c))
    plain = F.concat_ws("\n", line("ID", F.col("document_id")), line("Medicamento", F.col("nombre_medicamento")), line("Laboratorio", F.col("laboratorio_titular")), line("Autorización", F.col("fecha_primera_autorizacion")), line("Especies", species_text(docs)), line("Principios activos", F.col("principios_activos")))
    made = F.nullif(F.col("_found"), F.lit(""))
    return docs.join(texts.select("document_id", F.col("essential").alias("_found")), "document_id", "left").select("document_id", F.coalesce(made, plain).alias("essential"), made.isNull().alias("made"))


def complete_text(docs: DataFrame) -> DataFrame:
    """(document_id, text): the whole record as one chunk, labels in fixed order, absent blocks left out.

    Blocks that end in a line end are followed by an empty line.
    """
    listed = lambda head, array, item: F.when(F.size(array) > 0, F.concat(F.lit(f"{head}:\n"), F.array_join(F.transform(array, lambda x: F.concat(F.lit("- "), item(x))), "\n")))
    always = lambda label, c: F.concat(F.lit(f"{label}: "), _text(c))
    name = lambda x: _text(x["nombre"])
    lines = lambda array, item=name: _text(F.array_join(F.transform(array, lambda x: F.concat(F.lit("- "), item(x), F.lit("\n"))), ""))
    strings = lambda items: F.array_join(F.transform(items, lambda t: F.concat(F.lit("- "), t, F.lit("\n"))), "")
    groups = lambda head, array, item=name: _in_groups(array, lambda x: species_name(x), item, lambda k, items: F.concat(F.lit(f"{head} "), k, F.lit(":\n"), strings(items)))
    of_species = lambda array: F.filter(array, lambda x: x["especie"].isNotNull())
    general = lambda array: F.filter(array, lambda x: x["especie"].isNull())
    block = lambda head, array, *texts: F.when(F.size(array) > 0, F.concat(F.lit(f"{head}:\n"), *texts))
    reaction = lambda x: F.when(~_blank(x["frecuencia"]["nombre"]), F.concat(name(x), F.lit(" ("), x["frecuencia"]["nombre"], F.lit(")"))).otherwise(name(x))
    own = lambda x: F.coalesce(x["es_especie"], F.lit(False))
    never = F.filter(general("contraindicaciones"), own)
    plain = F.filter(general("contraindicaciones"), lambda x: ~own(x))
    waits = lambda x: F.concat(_text(x["tejido"]["nombre"]), F.lit(": "), _text(x["cantidad"]), F.lit(" "), _text(x["unidadTiempo"]["nombre"]))
    atc = F.array_join(F.transform("codigos_atc", lambda a: F.concat(F.lit("- "), _text(a["codigo"]), F.lit(": "), _text(a["nombre"]), F.lit(" (Nivel "), _text(a["nivel"].cast("string")), F.lit(")"))), "\n")
    parts = [
        always("Ficha técnica", F.col("nombre_medicamento")), always("Enlace", F.col("url")), always("Laboratorio titular", F.col("laboratorio_titular")), always("Fecha de primera autorización", F.col("fecha_primera_autorizacion")),
        always("Especies de destino", species_text(docs)), F.concat(F.lit("Códigos ATC:\n"), _text(atc)), always("Principios activos", F.col("principios_activos")),
        listed("Principios activos detallados", "principios_activos_registro", lambda p: F.concat(name(p), F.lit(": "), _text(p["cantidad"]), F.lit(" "), _text(p["unidad"]))),
        always("Excipientes", F.col("excipientes")), always("Forma farmacéutica", F.col("forma_farmaceutica")), always("Condiciones de dispensación", F.col("condiciones_dispensacion")), always("Condiciones de administración", F.col("condiciones_administracion")),
        F.concat(F.lit("Este medicamento"), F.when(F.coalesce("es_antibiotico", F.lit(False)), "").otherwise(" no"), F.lit(" es un antibiótico.")),
        listed("Vías de administración", "vias_administracion", name),
        block("Indicaciones", "indicaciones", groups("Indicaciones para", "indicaciones")),
        block("Contraindicaciones", "contraindicaciones", lines(plain), groups("Contraindicaciones para", of_species("contraindicaciones")), F.when(F.size(never) > 0, F.concat(F.lit("No usar en las siguientes especies:\n"), lines(never, lambda x: F.coalesce(x["nombre_normalizado"], x["nombre"], F.lit(""))))).otherwise("")),
        block("Reacciones adversas", "reacciones_adversas", lines(general("reacciones_adversas"), reaction), groups("En", of_species("reacciones_adversas"), reaction)),
        block("Interacciones", "interacciones", lines(general("interacciones")), groups("En", of_species("interacciones"))),
        F.when(~_blank(F.col("tiempo_espera_texto")), F.concat(F.lit("Tiempo de espera: "), F.col("tiempo_espera_texto"))).otherwise(block("Tiempo de espera", "tiempo_espera", groups("En", "tiempo_espera", waits))),
        listed("Presentaciones", "presentaciones", name), F.lit("-----"),
    ]
    return docs.select("document_id", F.concat_ws("\n", *parts).alias("text"))


def with_metadata(master: DataFrame, metadata: DataFrame, key: str = "nregistro") -> DataFrame:
    """Master records with their metadata; records without stay, with a null."""
    return master.join(metadata, key, "left")


def quarantined(docs: DataFrame, master: DataFrame, key: str = "document_id") -> tuple[DataFrame, DataFrame]:
    """(documents joined with their master record by nregistro, documents without one and why)."""
    known = master.withColumnRenamed("nregistro", key)
    return docs.join(known, key), docs.join(known.select(key), key, "left_anti").select(key, F.lit("no master record").alias("reason"))


def assemble(docs: DataFrame, master: DataFrame, base: str, key: str = "document_id") -> DataFrame:
    """Structured documents of docs(document_id, especies_destino, secciones) and master records with metadata.

    Absent texts are '' and absent lists empty; the date is Spanish, the url is
    base, the registration and FT_ with the registration again.  Documents
    without a record are left out; quarantined() tells which.
    """
    joined, _ = quarantined(docs, master, key)
    number = F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "^FT_", ""), "_ESP$", " ESP"), " ", "%20")
    text = lambda c: _text(F.col(c))
    listed = lambda c: F.coalesce(F.col(c), F.array().cast(joined.select(c).schema[0].dataType))
    of = lambda source, name: F.coalesce(F.col(f"metadata.{source}"), F.array().cast(joined.select(F.col(f"metadata.{source}").alias("x")).schema["x"].dataType)).alias(name)
    return joined.select(
        key, text("nombre").alias("nombre_medicamento"), F.concat(F.lit(base), number, F.lit("/FT_"), number, F.lit(".pdf")).alias("url"), text("labtitular").alias("laboratorio_titular"),
        spanish_date(F.col("primeraAutorizacion")).alias("fecha_primera_autorizacion"), listed("atcs").alias("codigos_atc"), text("especies_destino").alias("especies_destino"), of("especies", "especies_registro"),
        text("pactivos").alias("principios_activos"), of("principiosActivos", "principios_activos_registro"), text("excip").alias("excipientes"),
        _text(F.col("forma.nombre")).alias("forma_farmaceutica"), _text(F.col("dispensacion.nombre")).alias("condiciones_dispensacion"), _text(F.col("administracion.nombre")).alias("condiciones_administracion"),
        F.coalesce("is_antibiotic", F.lit(False)).alias("es_antibiotico"), of("viasAdministracion", "vias_administracion"), of("indicaciones", "indicaciones"), of("contraindicaciones", "contraindicaciones"),
        of("reaccionesAdversas", "reacciones_adversas"), of("interacciones", "interacciones"), of("tiemposEspera", "tiempo_espera"), _text(F.col("metadata.tiempoEsperaTexto")).alias("tiempo_espera_texto"), of("presentaciones", "presentaciones"), "secciones",
    )


def parse_documents(files: DataFrame, master: DataFrame, base: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(structured documents, files left out and why) of Markdown files(name, content) and catalogue records.

    The file name tells the registration; European documents are cut after
    their last section.  A file without content or without a record is left out.
    """
    named = files.select(canonical_doc_id(F.col("name")).alias("document_id"), F.col("content").alias("text"))
    european = F.startswith("document_id", F.lit("EU"))
    docs = named.withColumn("text", F.when(european, trim_after_last_section(F.col("text"))).otherwise(F.col("text")))
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    parsed = stored(docs.filter(~empty).select("document_id", "text", parsed_sections("text", strict).alias("parsed")), "sections")
    rows = parsed.select("document_id", F.inline("parsed"))
    none = F.array().cast("array<struct<seccion_id:string,titulo:string,contenido:string,subsecciones:array<struct<seccion_id:string,titulo:string,contenido:string>>>>")
    trees = parsed.select("document_id", section_tree(F.col("parsed")).alias("secciones"))
    parsed = target_species(rows, parsed.select("document_id", "text")).join(trees, "document_id", "left").withColumn("secciones", F.coalesce("secciones", none))
    lost = quarantined(parsed, master)[1]
    return assemble(parsed, master, base), docs.filter(empty).select("document_id", F.lit("no content").alias("reason")).unionByName(lost)


def record_keys(master: DataFrame) -> DataFrame:
    """(nregistro) of all records."""
    return master.select("nregistro")


def record_names(master: DataFrame) -> DataFrame:
    """(nregistro, nombre) of the records with a name."""
    return master.filter(F.coalesce(F.trim("nombre"), F.lit("")) != "").select("nregistro", "nombre")


def split_registrations(ids: DataFrame, key: str = "nregistro") -> tuple[DataFrame, DataFrame]:
    """(European registrations, all others), by the prefix EU."""
    european = F.coalesce(F.startswith(key, F.lit("EU")), F.lit(False))
    return ids.filter(european), ids.filter(~european)


def section_chunks(docs: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """Chunks of sections and subsections: chunk_id, document_id, chunk_type, title, parent_id, path, text."""
    name = F.coalesce("nombre_medicamento", F.lit(""))
    wrap = lambda head, body: F.concat(F.lit("Nombre del Medicamento: "), name, F.lit("\n\n"), head, F.lit("\n"), F.coalesce(body, F.lit("")), F.lit("\n-----"))
    ident = lambda c: F.concat(F.col("document_id"), F.lit(separator), c)
    head = lambda s: F.concat(s["seccion_id"], F.lit(". "), s["titulo"])

    def chunk(kind: str, item: Column, parent: Column, path: Column, title: Column) -> Column:
        return F.struct(ident(item["seccion_id"]).alias("chunk_id"), F.lit(kind).alias("chunk_type"), item["titulo"].alias("title"), ident(parent).alias("parent_id"), path.alias("path"), wrap(title, item["contenido"]).alias("text"))

    def of(s: Column) -> Column:
        top = chunk("section", s, F.lit("full"), F.array(s["titulo"]), head(s))
        subs = F.transform(s["subsecciones"], lambda u: chunk("subsection", u, s["seccion_id"], F.array(s["titulo"], u["titulo"]), F.concat(head(s), F.lit(" - "), u["seccion_id"], F.lit(" "), u["titulo"])))
        return F.concat(F.array(top), F.coalesce(subs, F.array().cast("array<struct<chunk_id:string,chunk_type:string,title:string,parent_id:string,path:array<string>,text:string>>")))

    rows = docs.select("document_id", F.inline(F.flatten(F.transform("secciones", of))))
    return rows.select("chunk_id", "document_id", "chunk_type", "title", "parent_id", "path", "text")


def normalise_nested(df: DataFrame, array: str, names: DataFrame, own: bool = False) -> DataFrame:
    """df with nombre_normalizado in the species structs of an array; names is (raw, normalised, known).

    own: an item without a species whose own name the dictionary knows is
    itself a species, and gets es_especie and nombre_normalizado.  Items with a
    null name and no species are dropped first.  The distinct names are looked
    up by a join, so the dictionary's size does not matter.
    """
    kept = F.filter(array, lambda x: x["nombre"].isNotNull() | x["especie"]["nombre"].isNotNull())
    rows = df.withColumn("_row", F.monotonically_increasing_id()).select("*", F.posexplode_outer(kept).alias("_at", "_x"))
    asked = F.coalesce(F.col("_x.especie.nombre"), F.trim("_x.nombre")) if own else F.col("_x.especie.nombre")
    joined = rows.withColumn("_asked", asked).join(names.select(F.col("raw").alias("_asked"), F.col("normalised").alias("_norm"), F.col("known").alias("_known")), "_asked", "left")
    has = F.col("_x.especie.nombre").isNotNull()
    item = F.col("_x").withField("especie", F.when(has, F.struct(F.col("_x.especie.nombre").alias("nombre"), F.coalesce("_norm", F.col("_x.especie.nombre")).alias("nombre_normalizado"))))
    if own:
        itself = ~has & F.coalesce("_known", F.lit(False))
        item = item.withField("es_especie", itself).withField("nombre_normalizado", F.when(itself, F.col("_norm")))
    keep = [c for c in df.columns if c != array]
    done = joined.groupBy("_row").agg(*[F.first(c).alias(c) for c in keep], F.array_sort(F.collect_list(F.when(F.col("_x").isNotNull(), F.struct("_at", item.alias("x"))))).alias("_all"))
    return done.select(*[c if c != array else F.transform("_all", lambda s: s["x"]).alias(array) for c in df.columns])
