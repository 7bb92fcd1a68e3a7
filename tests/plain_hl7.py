"""The parse contract in plain Python, written apart from the Spark job to check it."""


def parse(text):
    failed = dict.fromkeys(
        ("patient_id", "admit_location", "admit_diagnosis", "message_type", "facility"), ""
    )

    def failure(cause):
        return {**failed, "facility": f"PARSE_ERROR: {cause}", "is_parse_error": True}

    if text is None:
        return failure("no message text")
    text = text.strip(" \t\r\n\x0b\x0c")
    if not text.startswith("MSH"):
        return failure("first segment is not MSH")
    separator = text[3:4]
    if separator in ("", "\r", "\n"):
        return failure("MSH segment ends before field 9")
    first = {}
    for line in text.replace("\n", "\r").split("\r"):
        pieces = line.split(separator)
        first.setdefault(pieces[0], pieces)

    def field(name, number):
        pieces = first.get(name, [])
        place = number - 1 if name == "MSH" else number
        return pieces[place] if place < len(pieces) else ""

    if len(first["MSH"]) < 9:
        return failure("MSH segment ends before field 9")
    facility = field("MSH", 3)
    return {
        "patient_id": field("PID", 3),
        "admit_location": field("EVN", 7) or facility,
        "admit_diagnosis": field("DG1", 3),
        "message_type": field("MSH", 9),
        "facility": facility,
        "is_parse_error": False,
    }
