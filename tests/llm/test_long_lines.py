"""Navigation is a matter of density: a few separators in long prose are none."""

from ledgerloom.llm import quality


def test_prose_in_one_line_with_a_few_slashes_stays(spark):
    words = [f"word{i}" for i in range(400)]
    for at in (50, 150, 300):
        words[at] = "/"
    prose = " ".join(words) + "."
    menu = "\nHome | About us | Contact | Terms and prices | Login"
    cases = [(1, prose), (2, prose.replace(" / ", " > ")), (3, prose + menu), (4, " ".join(["Entry | of | menu |"] * 60))]
    found = {r.doc_id: r for r in quality.quality(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert [found[i].kept for i in (1, 2, 3, 4)] == [True, True, True, False]
    assert found[1].clean_text == found[3].clean_text == prose


def test_entries_of_some_words_are_navigation():
    assert quality.line_fails("Our latest news and stories | All products and their prices | Contact") == "navigation"
    assert quality.line_fails("| Home |") == "navigation"
    assert quality.line_fails("The rate / fee is due in the month after the end of the term / year, and a late one costs more.") == ""
