"""Several copies of a template in one chain of fingerprint hits."""

from patronage.llm import license_scan


def test_copies_with_phrases_of_the_template_between_them_are_all_found():
    index = license_scan.LicenseIndex(license_scan.TEMPLATES)
    header = license_scan.TEMPLATES["apache-2.0-header"]
    words = license_scan.words_of(header)
    size = len(words)
    places = [p for hits in index.found.values() for name, p in hits if name == "apache-2.0-header"]
    # the first and the last phrase that the index holds: their diagonals join the copies' ones
    phrases = [b" ".join(words[p : p + license_scan.GRAM]).decode() for p in (min(places), max(places))]
    for count in (3, 40, 400):
        between = " ".join(f"{phrases[i % 2]} x{i}" for i in range(count))
        text = " ".join([header, between, header, between, header])
        found = [m for m in index.scan(text) if m.template == "apache-2.0-header"]
        gap = 4 * count
        assert [m.first for m in found] == [0, size + gap, 2 * (size + gap)]
        assert [m.end - m.first for m in found] == [size] * 3 and all(m.matched == size for m in found)


def test_bands_have_a_fixed_width_and_cover_the_chain():
    bands = list(license_scan._bands(list(range(0, 5000, 3)), 4, 100))
    assert max(high - low for low, high in bands) <= 100
    assert bands[0][0] == -4 and bands[-1][1] == 4998 + 4
    assert all(b[0] <= a[1] - 50 for a, b in zip(bands, bands[1:]))
