"""Sentences that trigger the rules.

The supplied prose hardly holds a URL, tag, emoji or Azerbaijani word, so the
checks append one of these to each whole text, by the length of the text.
"""

SNIPPETS = (
    "Yaxsi idi amma qiymet cox baha idi :((",
    "#QarabagIsBack",
    "Bu məhsul çox yaxşı, 5 ulduz! 20 azn",
    "Bu yaxşı deyil o çox baha 3 dəfə",
    "yox 5 a b c d",
    "əla 😊 günlər 👍😡",
    "mail me: a.b@x.az www.site.az +994 50 123 45 67 @ali IŞIQ",
    "COOOOL tmm!!! rt",
    "Sabah apa bildirib ki #ok",
    "heç heç bir iki üç dörd",
    "#yaxşı gün",
    "1 2 3 4 ədəd",
    "12345678",
    "<b>Salam</b> &amp; sagol",
    "Qiymət. Gəldi! Getdi?",
    "a o e x",
    "İşçilər çooooox PİS yoxdur!!! deyil?? #SabahGörüşərik #aBcDe_F",
    "yaxÅŸÄ± gÃ¶zÉ™l É™la ﬁlm ＡＢＣ",
    "&lt;i&gt; caf&#233; &#x259;la &copy; &quot;yox&quot; &amp;lt; &nbsp;son",
    "ge" + chr(0x307) + "t s" + chr(0x327) + "ey I" + chr(0x307) + "sti o" + chr(0x308) + "z",
    "https://www.Example.com/a?b=C#d HTTP://x.az, qətiyyən bu çox pis idi sim cox cox yaxsi",
    "(012) 345-67-89 Aldım 3 manat 4 ulduz çox yaxşı çox pis yaxşı",
    "&amp;quot;x y&amp;quot; &amp;amp;amp;lt;z &#38;copy; &amp;b",
    "RT @user_1: trendy trend məqalə, bloomberg.",
)
