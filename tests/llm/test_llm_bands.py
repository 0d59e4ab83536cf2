"""Ordinary text of several scripts, none of which set the limits, is not judged incompressible."""

from __future__ import annotations

import pydoc_data.topics
import pytest

from asiento.llm import quality_rules

CHINESE = """人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。人人有资格享受本宣言所载的一切权利和自由，不分种族、肤色、性别、语言、宗教、政治或其他见解、国籍或社会出身、财产、出生或其他身分等任何区别。人人有权享有生命、自由和人身安全。任何人不得使为奴隶或奴役；一切形式的奴隶制度和奴隶买卖，均应予以禁止。任何人不得加以酷刑，或施以残忍的、不人道的或侮辱性的待遇或刑罚。人人在任何地方有权被承认在法律前的人格。法律之前人人平等，并有权享受法律的平等保护，不受任何歧视。任何人的私生活、家庭、住宅和通信不得任意干涉，他的荣誉和名誉不得加以攻击。人人有权享受法律保护，以免受这种干涉或攻击。人人在各国境内有权自由迁徙和居住。人人有权离开任何国家，包括其本国在内，并有权返回他的国家。成年男女，不受种族、国籍或宗教的任何限制，有权婚嫁和成立家庭。人人有思想、良心和宗教自由的权利。"""
POLISH = """Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek ma prawo do życia, wolności i bezpieczeństwa swej osoby. Nie wolno nikogo czynić niewolnikiem ani nakładać na nikogo służebności; niewolnictwo i handel niewolnikami są zakazane we wszystkich swych postaciach. Nie wolno nikogo torturować ani karać lub traktować w sposób okrutny, nieludzki lub poniżający. Każdy człowiek ma prawo do uznawania wszędzie jego osobowości prawnej. Wszyscy są równi wobec prawa i mają prawo, bez jakiejkolwiek różnicy, do jednakowej ochrony prawnej. Nikogo nie wolno samowolnie aresztować, zatrzymać lub wygnać z kraju. Nie wolno ingerować samowolnie w czyjekolwiek życie prywatne, rodzinne, domowe, ani w jego korespondencję, ani też uwłaczać jego honorowi lub dobremu imieniu. Każdy człowiek ma prawo swobodnego poruszania się i wyboru miejsca zamieszkania w granicach każdego państwa."""
RUSSIAN = """Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность. Никто не должен содержаться в рабстве или в подневольном состоянии; рабство и работорговля запрещаются во всех их видах. Никто не должен подвергаться пыткам или жестоким, бесчеловечным или унижающим его достоинство обращению и наказанию. Каждый человек, где бы он ни находился, имеет право на признание его правосубъектности. Все люди равны перед законом и имеют право, без всякого различия, на равную защиту закона."""


@pytest.mark.parametrize("text", [CHINESE, POLISH, RUSSIAN, *(pydoc_data.topics.topics[t] for t in ("class", "import", "exceptions", "specialnames"))])
def test_ordinary_text_is_not_incompressible(text):
    bands = quality_rules.Bands()
    compress = quality_rules.zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
    data = text.encode()
    for size in [b.min_bytes for b in bands.whole if b.min_bytes <= len(data)]:
        for start in range(0, len(data) - size + 1, size):
            cut = data[start : start + size].decode("utf-8", "ignore")
            whole = cut.encode()
            assert bands.judge(len(whole), len(compress(whole)) / len(whole), len(cut)) <= 0, (size, cut)


def test_limits_by_bytes_of_a_code_point():
    bands = quality_rules.Bands()
    assert bands.judge(1024, 0.72) == 1 and bands.judge(1024, 0.72, 1000) == 1
    assert bands.judge(1024, 0.72, 900) == 0 and bands.judge(1024, 0.8, 900) == 1
    assert bands.judge(1024, 0.8, 400) == 0 and bands.judge(1024, 0.9, 400) == 1 and bands.judge(1024, 0.3, 400) == -1
    assert bands.judge(0, 1.0, 0) == 0


def test_noise_of_any_width_is_rejected(spark):
    import random

    rng = random.Random(4)
    wide = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(12)) for _ in range(200))
    plain = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(9)) for _ in range(300))
    rows = [(1, wide), (2, plain), (3, CHINESE), (4, POLISH), (5, None), (6, "")]
    found = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not found[1].base_failed and not found[1].kept and not found[2].base_failed and not found[2].kept
    assert found[3].base_failed and found[4].kept and found[5].base_failed and found[6].n_words == 0
