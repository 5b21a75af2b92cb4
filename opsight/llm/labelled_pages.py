"""Labelled pages: layouts with `data-main` on the parts that are the article (1) or are not (0).

The layouts cover the usual places of menus, headers, footers, side bars, notices, adverts, forms and reader comments,
with and without semantic elements. Each is filled with sentences of several lengths.
"""

from __future__ import annotations

#: Sentences of invented prose to fill the layouts with.
SHORT = ("Of the hill.", "Warm rain fell.", "En la casa.", "Sie kam heim", "Il part demain.", "Notes | on | tides")
LONG = (
    "The ferry left the island before sunrise, and most of the crew had not slept, since the storm kept them at work.",
    "A second survey of the valley found older walls, which changes what is known about the first houses there.",
    "Der Fluss trat im Frühjahr über die Ufer, doch die neuen Dämme hielten, und die Stadt blieb trocken.",
    "Les pêcheurs attendent le vent du nord, car les courants changent alors et les filets se remplissent plus vite.",
    "El mercado abre a las siete, aunque los vendedores llegan mucho antes para encontrar un buen lugar en la plaza.",
    "rows | of | words | that | stand | apart | with | bars | between | them | and | no | stop | at | all | here",
)
LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport,", "travel.", "Kultur", "archive"))

LAYOUTS = (
    # semantic elements, advert after the menu
    '<body data-main="0"><nav><ul>{links}</ul></nav><div class="ad">{long}</div><article data-main="1"><h1>{head}</h1>'
    '<p>{long}<p>{short}</p><p><b>{long2}<br>{short}</p><p>{short2}</p></article><footer>&copy; site {short}</footer></body>',
    '<body data-main="0"><nav><ul>{links}</ul></nav><div class="ad">{short}</div><article data-main="1"><h1>{short}</h1>'
    '<p><b>{short}<br><p>{short2}</p></article><footer>&copy; site &middot; {long}</footer>',
    # header, side bar, comments after the article
    '<body data-main="0"><header><h1>{short}</h1><p>{long}</p></header><div class="cookie-notice"><p>{long}</p></div><main>'
    '<article data-main="1"><h1>{head}</h1><p>{long}</p><p>{long2}</p><blockquote>{short}</blockquote><ul><li>{short2}</li>'
    '</ul></article><section class="comments" id="comments"><h2>{short}</h2><div class="comment"><p>{long2}</p></div>'
    '<div class="comment"><p>{short2}</p></div></section></main><aside class="sidebar"><h3>{short}</h3><p>{long}</p></aside>'
    '<footer><p>{long}</p></footer></body>',
    # divisions only
    '<body data-main="0"><div id="header"><div class="logo">{short}</div></div><div class="menu nav"><a href="/">{short}</a>'
    '<a href="/b">{short2}</a></div><div class="banner notice">{long}</div><div id="content" class="post content"'
    ' data-main="1"><h2>{head}</h2><p>{long}</p><p>{short}</p><table><tr><td>{short2}</td></tr></table><p>{long2}</p></div>'
    '<div class="sidebar widget"><p>{long}</p><ul>{links}</ul></div><div class="newsletter"><form><p>{long2}</p><button>'
    '{short}</button></form></div><div id="footer" class="footer">{short} © 2020</div></body>',
    # advert, share box and related links inside the article
    '<body data-main="0"><header class="site-header">{short}</header><div role="navigation">{links}</div><main><article'
    ' data-main="1"><header data-main="1"><h1>{head}</h1></header><p>{long}</p><div class="advert ads" data-main="0">{long2}'
    '</div><p>{long2}</p><aside class="related" data-main="0"><p>{long}</p></aside><div class="share social" data-main="0">'
    '<a href="/s">{short}</a></div><h2>{short}</h2><p>{short2}</p><p>{long}</p></article></main>'
    '<div class="comments-list"><ol><li>{long}</li><li>{short}</li></ol></div><footer>{long}</footer></body>',
    # form and promotion first, reader comments as a list
    '<body data-main="0"><form class="search" action="/q"><label>{short}</label><p>{short2}</p></form><div class="promo'
    ' sponsored"><p>{long}</p></div><section class="article-body" data-main="1"><h1>{head}</h1><p>{short}</p><p>{long}</p>'
    '<h3>{short2}</h3><p>{long2}</p><pre>{short}</pre></section><ul class="comments"><li class="comment reply">{long}</li>'
    '<li class="comment">{long2}</li></ul><div class="popup modal subscribe">{long}</div><footer class="legal">{long}'
    '</footer></body>',
    # no article at all
    '<body data-main="0"><nav>{links}</nav><div class="ad">{long}</div><div class="notice">{short}</div><aside><p>{long2}'
    '</p></aside><form><p>{short}</p></form><footer>{long}</footer></body>',
    # plain page
    '<body data-main="0"><nav>{links}</nav><main data-main="1"><h1>{head}</h1><p>{long}</p><p>{short}</p><dl><dt>{short2}'
    '</dt><dd>{long2}</dd></dl></main><div class="disclaimer alert">{long}</div><footer><nav>{links}</nav></footer></body>',
)


def _filled(layout: str, n: int) -> str:
    pick = lambda rows, k: rows[(n + k) % len(rows)]
    return layout.format(links=LINKS, head=pick(SHORT, 2)[:-1], short=pick(SHORT, 0), short2=pick(SHORT, 3),
                         long=pick(LONG, 0), long2=pick(LONG, 1))


PAGES = tuple(_filled(layout, n) for layout in LAYOUTS for n in range(6))
