"""Emoji code points and their names.

The names follow the rule "Unicode name, lower case, underscores"; RENAMED holds common ones whose
short name in the public CLDR data differs from that rule. Sequences joined by U+200D follow the
rules of `joined`; those that no rule covers get the names of their parts.
"""

import re
import unicodedata

import numpy as np

# Code points with the public Unicode property Emoji, without digits, # and *.
RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2
25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A
262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697
2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1
26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721
2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935
2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E
1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397
1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570
1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4
1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2
1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A
1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8
"""

# Short names that differ from the Unicode name.
RENAMED = {
    "©": "copyright",
    "®": "registered",
    "™": "trade_mark",
    "ℹ": "information",
    "↔": "left-right_arrow",
    "↕": "up-down_arrow",
    "↖": "up-left_arrow",
    "↗": "up-right_arrow",
    "↘": "down-right_arrow",
    "↙": "down-left_arrow",
    "↩": "right_arrow_curving_left",
    "↪": "left_arrow_curving_right",
    "⌛": "hourglass_done",
    "⏏": "eject_button",
    "⏩": "fast-forward_button",
    "⏪": "fast_reverse_button",
    "⏫": "fast_up_button",
    "⏬": "fast_down_button",
    "⏭": "next_track_button",
    "⏮": "last_track_button",
    "⏯": "play_or_pause_button",
    "⏳": "hourglass_not_done",
    "⏸": "pause_button",
    "⏹": "stop_button",
    "⏺": "record_button",
    "▶": "play_button",
    "◀": "reverse_button",
    "☀": "sun",
    "☎": "telephone",
    "☑": "check_box_with_check",
    "☝": "index_pointing_up",
    "☢": "radioactive",
    "☣": "biohazard",
    "☹": "frowning_face",
    "☺": "smiling_face",
    "♠": "spade_suit",
    "♣": "club_suit",
    "♥": "heart_suit",
    "♦": "diamond_suit",
    "♻": "recycling_symbol",
    "♾": "infinity",
    "⚖": "balance_scale",
    "⚠": "warning",
    "⚡": "high_voltage",
    "⛈": "cloud_with_lightning_and_rain",
    "⛑": "rescue_worker’s_helmet",
    "⛹": "person_bouncing_ball",
    "✂": "scissors",
    "✅": "check_mark_button",
    "✔": "check_mark",
    "✖": "multiply",
    "✡": "star_of_David",
    "❎": "cross_mark_button",
    "❓": "red_question_mark",
    "❔": "white_question_mark",
    "❕": "white_exclamation_mark",
    "❗": "red_exclamation_mark",
    "❣": "heart_exclamation",
    "❤": "red_heart",
    "➕": "plus",
    "➖": "minus",
    "➗": "divide",
    "➡": "right_arrow",
    "⤴": "right_arrow_curving_up",
    "⤵": "right_arrow_curving_down",
    "⬅": "left_arrow",
    "⬆": "up_arrow",
    "⬇": "down_arrow",
    "⭐": "star",
    "⭕": "hollow_red_circle",
    "🅰": "A_button_(blood_type)",
    "🅱": "B_button_(blood_type)",
    "🅾": "O_button_(blood_type)",
    "🅿": "P_button",
    "🆎": "AB_button_(blood_type)",
    "🆑": "CL_button",
    "🆒": "COOL_button",
    "🆓": "FREE_button",
    "🆔": "ID_button",
    "🆕": "NEW_button",
    "🆖": "NG_button",
    "🆗": "OK_button",
    "🆘": "SOS_button",
    "🆙": "UP!_button",
    "🆚": "VS_button",
    "🌍": "globe_showing_Europe-Africa",
    "🌎": "globe_showing_Americas",
    "🌏": "globe_showing_Asia-Australia",
    "🌚": "new_moon_face",
    "🌝": "full_moon_face",
    "🌦": "sun_behind_rain_cloud",
    "🌪": "tornado",
    "🌬": "wind_face",
    "🌽": "ear_of_corn",
    "🌾": "sheaf_of_rice",
    "🍆": "eggplant",
    "🎁": "wrapped_gift",
    "🎇": "sparkler",
    "🎯": "bullseye",
    "🎶": "musical_notes",
    "🏃": "person_running",
    "🏄": "person_surfing",
    "🏊": "person_swimming",
    "🏋": "person_lifting_weights",
    "🏌": "person_golfing",
    "🏍": "motorcycle",
    "🏠": "house",
    "🏧": "ATM_sign",
    "🏳": "white_flag",
    "🏴": "black_flag",
    "👆": "backhand_index_pointing_up",
    "👇": "backhand_index_pointing_down",
    "👈": "backhand_index_pointing_left",
    "👉": "backhand_index_pointing_right",
    "👊": "oncoming_fist",
    "👋": "waving_hand",
    "👌": "OK_hand",
    "👍": "thumbs_up",
    "👎": "thumbs_down",
    "👏": "clapping_hands",
    "👐": "open_hands",
    "👝": "clutch_bag",
    "👟": "running_shoe",
    "👯": "people_with_bunny_ears",
    "👱": "person_blond_hair",
    "👲": "person_with_skullcap",
    "👳": "person_wearing_turban",
    "👴": "old_man",
    "👵": "old_woman",
    "👹": "ogre",
    "👺": "goblin",
    "👽": "alien",
    "👿": "angry_face_with_horns",
    "💁": "person_tipping_hand",
    "💂": "guard",
    "💃": "woman_dancing",
    "💆": "person_getting_massage",
    "💇": "person_getting_haircut",
    "💠": "diamond_with_a_dot",
    "💡": "light_bulb",
    "💤": "ZZZ",
    "💥": "collision",
    "💦": "sweat_droplets",
    "💨": "dashing_away",
    "💫": "dizzy",
    "💯": "hundred_points",
    "💵": "dollar_banknote",
    "💹": "chart_increasing_with_yen",
    "💻": "laptop",
    "💽": "computer_disk",
    "💿": "optical_disk",
    "📈": "chart_increasing",
    "📉": "chart_decreasing",
    "📢": "loudspeaker",
    "📣": "megaphone",
    "📧": "e-mail",
    "📩": "envelope_with_arrow",
    "📲": "mobile_phone_with_arrow",
    "📶": "antenna_bars",
    "🔁": "repeat_button",
    "🔂": "repeat_single_button",
    "🔃": "clockwise_vertical_arrows",
    "🔄": "counterclockwise_arrows_button",
    "🔅": "dim_button",
    "🔆": "bright_button",
    "🔇": "muted_speaker",
    "🔈": "speaker_low_volume",
    "🔉": "speaker_medium_volume",
    "🔊": "speaker_high_volume",
    "🔍": "magnifying_glass_tilted_left",
    "🔎": "magnifying_glass_tilted_right",
    "🔏": "locked_with_pen",
    "🔐": "locked_with_key",
    "🔒": "locked",
    "🔓": "unlocked",
    "🔕": "bell_with_slash",
    "🔗": "link",
    "🔙": "BACK_arrow",
    "🔚": "END_arrow",
    "🔛": "ON!_arrow",
    "🔜": "SOON_arrow",
    "🔝": "TOP_arrow",
    "🔞": "no_one_under_eighteen",
    "🔟": "keycap_10",
    "🔤": "input_latin_letters",
    "🔪": "kitchen_knife",
    "🔫": "water_pistol",
    "🔯": "dotted_six-pointed_star",
    "🔰": "Japanese_symbol_for_beginner",
    "🔴": "red_circle",
    "🔵": "blue_circle",
    "🔺": "red_triangle_pointed_up",
    "🔻": "red_triangle_pointed_down",
    "😁": "beaming_face_with_smiling_eyes",
    "😃": "grinning_face_with_big_eyes",
    "😄": "grinning_face_with_smiling_eyes",
    "😅": "grinning_face_with_sweat",
    "😆": "grinning_squinting_face",
    "😋": "face_savoring_food",
    "😍": "smiling_face_with_heart-eyes",
    "😓": "downcast_face_with_sweat",
    "😘": "face_blowing_a_kiss",
    "😛": "face_with_tongue",
    "😜": "winking_face_with_tongue",
    "😝": "squinting_face_with_tongue",
    "😡": "enraged_face",
    "😤": "face_with_steam_from_nose",
    "😥": "sad_but_relieved_face",
    "😰": "anxious_face_with_sweat",
    "😵": "face_with_crossed-out_eyes",
    "🙅": "person_gesturing_NO",
    "🙆": "person_gesturing_OK",
    "🙇": "person_bowing",
    "🙋": "person_raising_hand",
    "🙌": "raising_hands",
    "🙎": "person_pouting",
    "🙏": "folded_hands",
    "🚂": "locomotive",
    "🚅": "bullet_train",
    "🚙": "sport_utility_vehicle",
    "🚣": "person_rowing_boat",
    "🚧": "construction",
    "🚨": "police_car_light",
    "🚫": "prohibited",
    "🚬": "cigarette",
    "🚭": "no_smoking",
    "🚴": "person_biking",
    "🚵": "person_mountain_biking",
    "🚶": "person_walking",
    "🛀": "person_taking_bath",
    "🛌": "person_in_bed",
    "🛑": "stop_sign",
    "🛒": "shopping_cart",
    "🟠": "orange_circle",
    "🟡": "yellow_circle",
    "🟢": "green_circle",
    "🟣": "purple_circle",
    "🤖": "robot",
    "🤗": "smiling_face_with_open_hands",
    "🤞": "crossed_fingers",
    "🤟": "love-you_gesture",
    "🤠": "cowboy_hat_face",
    "🤦": "person_facepalming",
    "🤨": "face_with_raised_eyebrow",
    "🤩": "star-struck",
    "🤪": "zany_face",
    "🤫": "shushing_face",
    "🤬": "face_with_symbols_on_mouth",
    "🤭": "face_with_hand_over_mouth",
    "🤮": "face_vomiting",
    "🤯": "exploding_head",
    "🤷": "person_shrugging",
    "🥰": "smiling_face_with_hearts",
    "🥳": "partying_face",
    "🥴": "woozy_face",
    "🥵": "hot_face",
    "🥶": "cold_face",
    "🥺": "pleading_face",
    "🧑": "person",
}

# Sequences with a name of their own, without U+200D and U+FE0F.
SEQUENCES = {
    "❤🔥": "heart_on_fire",
    "❤🩹": "mending_heart",
    "🏳🌈": "rainbow_flag",
    "🏳⚧": "transgender_flag",
    "🏴☠": "pirate_flag",
    "🐕🦺": "service_dog",
    "🐈⬛": "black_cat",
    "🐻❄": "polar_bear",
    "👁🗨": "eye_in_speech_bubble",
    "😮💨": "face_exhaling",
    "😵💫": "face_with_spiral_eyes",
    "😶🌫": "face_in_clouds",
}
# Parts of sequences of people.
PEOPLE = {"👨": "man", "👩": "woman", "🧑": "person"}
GENDERS = {"♂": "man", "♀": "woman"}
FAMILY = {"👨": "man", "👩": "woman", "👦": "boy", "👧": "girl"}
ROLES = {
    "⚕": "health_worker",
    "⚖": "judge",
    "✈": "pilot",
    "🌾": "farmer",
    "🍳": "cook",
    "🎓": "student",
    "🎤": "singer",
    "🎨": "artist",
    "🏫": "teacher",
    "🏭": "factory_worker",
    "💻": "technologist",
    "💼": "office_worker",
    "🔧": "mechanic",
    "🔬": "scientist",
    "🚀": "astronaut",
    "🚒": "firefighter",
    "🦯": "with_white_cane",
    "🦰": "red_hair",
    "🦱": "curly_hair",
    "🦲": "bald",
    "🦳": "white_hair",
    "🦼": "in_motorized_wheelchair",
    "🦽": "in_manual_wheelchair",
}

# Skin tones, U+1F3FB to U+1F3FF.
SKIN_TONES = ["light", "medium-light", "medium", "medium-dark", "dark"]

REGIONAL_A = 0x1F1E6
PIECE_CHARS = 1 << 16


def _spans():
    for part in RANGES.split():
        first, _, last = part.partition("-")
        yield int(first, 16), int(last or first, 16)


def java_class() -> str:
    """The set as a Java regular expression character class."""
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in _spans()) + "]"


def python_class() -> str:
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _spans()) + "]"


def name_of(char: str) -> str:
    tone = ord(char) - 0x1F3FB
    if 0 <= tone < len(SKIN_TONES):
        return f"{SKIN_TONES[tone]}_skin_tone"
    if char in RENAMED:
        return RENAMED[char]
    return unicodedata.name(char, "emoji").lower().replace(" ", "_")


def name_table() -> list[tuple[str, str]]:
    """(emoji, name) of every code point: about 1,400 rows."""
    return [(chr(c), name_of(chr(c))) for a, b in _spans() for c in range(a, b + 1)]


_FLAG = "([\U0001f1e6-\U0001f1ff])([\U0001f1e6-\U0001f1ff])"
_KEYCAP = "([0-9#*])️?⃣"
_TONE = "[\U0001f3fb-\U0001f3ff]"
_UNIT = f"{python_class()}\ufe0f?{_TONE}?"
_PATTERN = re.compile(f"{_FLAG}|{_KEYCAP}|({_UNIT}(?:\u200d{_UNIT})*)")


def unit(text: str) -> tuple[str, str]:
    """Base character of one part of a sequence, and its skin tone's name with an underscore in front."""
    base, *rest = text.replace("\ufe0f", "")
    return base, "".join(f"_{name_of(c)}" for c in rest)


def joined(parts: list[str]) -> str | None:
    """The one name of a sequence: fixed ones, a person with what they hold, a person with a gender sign."""
    units = [unit(part) for part in parts]
    bases, tone = "".join(base for base, _ in units), units[0][1]
    if bases in SEQUENCES:
        return SEQUENCES[bases]
    first, second = bases[0], bases[1:]
    if first in PEOPLE and second in ROLES:
        return f"{PEOPLE[first]}_{ROLES[second]}{tone}"
    if second in GENDERS:
        return f"{GENDERS[second]}_{name_of(first).removeprefix('person_')}{tone}"
    if set(bases) <= set(FAMILY):
        return "_".join(["family", *(FAMILY[base] for base in bases)])
    return None


def _described(found: re.Match) -> str:
    first, second, key, sequence = found.groups()
    if first:
        letters = (chr(ord("a") + ord(c) - REGIONAL_A) for c in (first, second))
        return f" flag_{''.join(letters)} "
    if key:
        return f" keycap_{key} "
    parts = sequence.split("\u200d")
    name = joined(parts) if len(parts) > 1 else None
    if name:
        return f" {name} "
    return "".join(f" {name_of(base)}{tone} " for base, tone in map(unit, parts))


# A flag for each code point up to the last emoji and one more: no match goes without a flagged one.
_MARKS = np.zeros(1 + max(last for _, last in _spans()) + 1, np.bool_)
for _first, _last in [*_spans(), (REGIONAL_A, REGIONAL_A + 25), (0x20E3, 0x20E3)]:
    _MARKS[_first : _last + 1] = True


def may_hold_emoji(text: str) -> bool:
    """Whether the text has a flagged code point; looking up pieces of the text is much faster than the pattern."""
    pieces = (text[at : at + PIECE_CHARS].encode("utf-32-le", "surrogatepass") for at in range(0, len(text), PIECE_CHARS))
    return any(_MARKS[np.minimum(np.frombuffer(p, "<u4"), len(_MARKS) - 1)].any() for p in pieces)


def demojize(text: str) -> str:
    """Every emoji as its name between spaces."""
    return _PATTERN.sub(_described, text) if may_hold_emoji(text) else text
