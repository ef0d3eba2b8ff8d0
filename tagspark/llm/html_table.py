"""Labelled pages the block classifier learns from.

One block per line: 1 for main text, 0 for the rest, then its markup. ``{n}``
stands for n words, ``{a:n}`` for a link of n words.
"""

PAGES = """
0 <html><body><nav><ul><li>{a:1}</li>
0 <li>{a:2}</li>
0 <li>{a:1}</li></ul></nav>
0 <div class="ad">{12}</div>
1 <article><h1>{9}</h1>
1 <p>{55}</p>
1 <p>{4}</p>
1 <p>{23} {a:2} {31}</p>
1 <p>{120}</p>
1 <p>{2}</p></article>
0 <footer>&copy; {3} {14}</footer></body></html>

0 <body><header><a href="/">{2}</a></header>
0 <div id="menu"><a href="/a">{1}</a> <a href="/b">{1}</a> <a href="/c">{2}</a></div>
1 <main><h1>{6}</h1>
1 <p>{18}</p>
1 <h2>{3}</h2>
1 <p>{64}</p>
1 <ul><li>{7}</li>
1 <li>{11}</li></ul>
1 <p>{38} {a:3}</p></main>
0 <aside><h3>{2}</h3>
0 <p>{16}</p>
0 <ul><li>{a:6}</li>
0 <li>{a:7}</li></ul></aside>
0 <footer><p>{9} {a:2} {a:2}</p></footer></body>

0 <body><div class="topbar">{a:1} {a:1} {a:1}</div>
0 <div class="cookie-notice">{22} <button>{1}</button></div>
1 <div class="content"><h1>{8}</h1>
1 <p>{33}</p>
1 <p>{47}</p>
1 <blockquote>{15}</blockquote>
1 <p>{5}</p></div>
0 <div class="share">{a:1} {a:1}</div>
0 <div id="comments"><h3>{2}</h3>
0 <div class="comment"><p>{26}</p></div>
0 <div class="comment"><p>{44}</p></div>
0 <form><label>{3}</label><textarea></textarea><button>{1}</button></form></div>
0 <div class="footer">{8}</div></body>

0 <body><ul><li>{a:1}</li>
0 <li>{a:1}</li>
0 <li>{a:2}</li></ul>
1 <h1>{7}</h1>
1 <p>{52}</p>
1 <p>{29} {a:2} {13}</p>
1 <p>{61}</p>
1 <p>{17}</p>
0 <p>{a:4} {a:5}</p>
0 <div>{a:3} | {a:2} | {a:2}</div>
0 <p>&copy; {5}</p></body>

0 <body><table><tr><td>{a:2}</td>
0 <td>{a:1}</td></tr></table>
1 <div><h2>{5}</h2>
1 <div>{75}</div>
1 <div>{41}</div>
1 <div>{26}</div></div>
0 <div class="sidebar"><p>{31}</p>
0 <p>{a:5}</p></div>
0 <div class="newsletter">{12} <input type="text"></div>
0 <div class="related"><a href="/x">{8}</a></div>
0 <p>{a:2} {a:1} {a:3}</p></body>

0 <body><nav>{a:1} {a:1} {a:1} {a:1} {a:1}</nav>
1 <article><header><h1>{10}</h1></header>
1 <p>{14}</p>
1 <p>{81}</p>
1 <p>{a:4}</p>
0 <div class="advert">{19}</div>
1 <p>{36}</p>
1 <p>{1}</p>
0 <section class="comments"><h2>{2}</h2>
0 <p>{58}</p></section></article>
0 <form action="/s">{2} <input name="q"></form>
0 <footer><p>{25}</p></footer></body>

0 <body><div class="banner">{17}</div>
0 <div class="notice">{28}</div>
1 <div id="main"><h1>{4}</h1>
1 <pre>{22}</pre>
1 <p>{9}</p>
1 <table><tr><td>{3}</td>
1 <td>{6}</td></tr></table>
1 <p>{90}</p></div>
0 <div class="widget"><h4>{2}</h4>
0 <p>{20}</p></div>
0 <div class="breadcrumbs">{a:1} {a:2}</div>
0 <div id="copyright">{7}</div></body>

0 <body><nav><ul><li>{a:2}</li></ul></nav>
1 <article><h1>{1}</h1>
1 <p>{1}</p>
1 <p>{44}</p>
1 <p>{1}</p>
1 <p>{70}</p>
1 <p>{1}</p>
1 <p>{1}</p>
1 <p>{12}</p></article></body>

1 <body><article><p>{90}</p>
1 <p>{1}</p></article>
0 <p>&copy; {2}</p>
0 <p>{a:1}</p>
0 <p>{a:2}</p></body>

0 <body><div>{a:1}</div>
0 <div>{a:2}</div>
0 <div>&copy; {4}</div>
1 <p>{66}</p>
1 <p>{1}</p>
1 <p>{58}</p>
1 <p>{2}</p>
1 <p>{41}</p>
1 <p>{24}</p></body>

0 <body><p>{a:3}</p>
1 <h1>{5}</h1>
1 <p>{35}</p>
1 <p>{1}</p>
1 <p>{27}</p>
0 <p>{a:3}</p>
0 <p>{a:1} {1} {a:2}</p>
0 <p>&copy; {6}</p></body>

1 <main><p>{a:3}</p>
1 <p>{a:1}</p>
1 <p>{a:7} {2}</p>
1 <p>{31}</p>
1 <p>{a:2}</p></main>
0 <div class="comments">{1}</div>
0 <div class="comments">{66}</div>
0 <div class="footer">{30} {a:1}</div></body>
""".strip()
