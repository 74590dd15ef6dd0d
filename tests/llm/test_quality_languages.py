from pyspark.sql import functions as F

from helioquery.llm.quality import line_fails, may_hold_boilerplate, with_quality

NAVIGATION = ["Home", "MENÜ", "Zurück", "über uns", "Lire la suite", "À propos", "Précédent", "Leer más", "MENÚ", "Iniciar sesión", "s'abonner"]
BOILERPLATE = [
    "All Rights Reserved", "Lorem Ipsum", "enable JavaScript", "Cookies", "Privacy Policy", "Terms of Service", "licensed under MIT", "released under the GPL", "Copyright © x", "copyright (C) x",
    "Alle Rechte vorbehalten", "DATENSCHUTZERKLÄRUNG", "Nutzungsbedingungen", "Impressum", "Tous droits réservés", "Politique de confidentialité", "Conditions d'utilisation", "MENTIONS LÉGALES",
    "Todos los derechos reservados", "POLÍTICA DE PRIVACIDAD", "Términos de uso", "Aviso legal",
]
CLEAN = ["the house stands on a hill", "das Haus steht am Fluss", "la maison est grande", "la casa es grande", "a menu of the day for two", "the terms of a sum"]


def test_rules_of_four_languages(spark):
    rows = spark.createDataFrame([(x, True) for x in NAVIGATION + [f"see {b} here" for b in BOILERPLATE]] + [(x, False) for x in CLEAN], "line string, fails boolean")
    got = rows.select("line", "fails", line_fails(F.col("line"), may_hold_boilerplate(F.col("line"))).alias("found")).collect()
    assert not [r["line"] for r in got if r["fails"] != r["found"]]


def test_only_the_lines_that_fail_go(spark):
    text = "\n".join(["a line of plain words"] * 3 + ["Accueil", "tous droits réservés par nous"] + ["another line of words"])
    got = with_quality(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()["clean_text"]
    assert got == "\n".join(["a line of plain words"] * 3 + ["another line of words"])
