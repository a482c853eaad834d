"""Pages written for training: every block says whether it is article text.

``data-main`` holds for an element and what is in it. The pages differ in how
much their markup tells: landmarks, class names only, or neither.
"""

LABELLED_PAGES = (
    # Landmarks, as most publishing systems write them.
    """<html><head><title>A day at sea</title><style>p{}</style></head><body>
    <nav data-main=0><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li>
    <li><a href="/s">Sports today</a></li></ul></nav>
    <div class="ad" data-main=0>Buy two pairs of boots and pay for one of them only.</div>
    <article data-main=1><h1>A day at sea</h1>
    <p>We left the harbour before the sun was up, and the wind was fair.</p><p>It held.</p>
    <p>By noon the coast was a thin line, and the nets were full of <a href="/h">herring</a> again.</p>
    <h2>The way home</h2><p>No.</p>
    <ul><li>Two boxes of herring</li><li>One of mackerel</li></ul></article>
    <aside data-main=0><h3>Read more</h3><p>The old pier is closed for repairs until the spring.</p></aside>
    <footer data-main=0>© 2020 The Harbour Post. All rights reserved. Write to us.</footer></body></html>""",
    # The same with comments by readers, a form and a notice.
    """<body><div class="cookie-notice" data-main=0><p>We use cookies to make this site better for you.</p>
    <button>Accept</button></div><header data-main=0><a href="/">The Daily Loaf</a><p>Bread and more.</p></header>
    <main data-main=1><h1>How to bake rye bread</h1><p>Mix flour, water and salt, and let it stand for a day.</p>
    <p>Heat the oven.</p><blockquote>My grandmother never used a scale.</blockquote>
    <section class="comments" data-main=0><h3>Three comments</h3><p>Anna: I tried it yesterday and it was very good, thank you.</p>
    <p>Tom: Mine was flat.</p></section>
    <form data-main=0><label>Your name</label><p>Leave a reply. Your address will not be shown to anybody.</p></form></main>
    <div id="newsletter" data-main=0><p>Get our letter every Friday. You can leave at any time.</p></div>
    <footer data-main=0><ul><li><a href="/i">Imprint</a></li><li>Call us on weekdays.</li></ul></footer></body>""",
    # Class names only.
    """<body><div class="top-menu" data-main=0><div><a href="/a">Garden</a> <a href="/b">House</a></div></div>
    <div class="post-content" data-main=1><h1>Pruning roses</h1>
    <p>Cut the stems in early spring, when the buds begin to swell and frost is over.</p><p>Use sharp shears.</p>
    <div>A clean cut heals well, and the plant will thank you with flowers.</div>
    <div class="share-buttons" data-main=0>Share this</div>
    <div class="related" data-main=0><div>More about plants</div><p>Ten shrubs that grow in the shade of tall trees.</p></div></div>
    <div class="sidebar" data-main=0><p>Our shop is open from nine to five, come and see the seeds.</p>
    <div class="widget"><a href="/t">Tools</a></div></div>
    <div class="banner" data-main=0><p>Summer sale. Everything must go this week.</p></div>
    <div class="copyright" data-main=0>© Rose Garden Society</div></body>""",
    # Nothing but text and links.
    """<body><div data-main=0><a href="/1">Start</a> | <a href="/2">Archive</a> | <a href="/3">About us</a></div>
    <div data-main=1><h1>The bridge over the river Ohm</h1></div>
    <div data-main=1>For two hundred years the wooden bridge carried carts, cattle and children to the other
    side of the river, until the flood of March took it away in one night and left nothing but the piers.</div>
    <div data-main=1>The council met the next morning and voted for a new one, to be built of stone this time,
    with two arches and a walk for those on foot, and it was opened in the autumn of the following year.</div>
    <div data-main=1>Since then it has been repaired only once, when a barge hit the second arch in a fog so
    thick that the crew could not see their own bow, as the report of the inquiry says in its first lines.</div>
    <div data-main=0><a href="/4">Older</a> <a href="/5">Newer</a></div>
    <div data-main=0>© River News</div></body>""",
    # A table for the layout.
    """<body><table><tr><td data-main=0><a href="/x">Index</a></td><td data-main=0><a href="/y">Guest book</a></td></tr>
    <tr><td data-main=1><p>My uncle kept bees behind the barn, in hives that he had painted blue so that
    the bees would know them from those of the neighbours, and every summer we went to help him.</p>
    <p>We wore hats with veils and gloves that were much too large, and we were proud of every sting that
    we could show at school, because nobody else in the class had an uncle with forty thousand bees.</p></td>
    <td data-main=0><a href="/z">Links to other pages about bees</a></td></tr></table>
    <p data-main=0><a href="/top">Back to top</a></p><p data-main=0>Copyright © by the author</p></body>""",
    # Short items around an article without a class.
    """<body><ul data-main=0><li><a href="/d">Deutsch</a></li><li><a href="/e">English</a></li><li><a href="/f">Français</a></li></ul>
    <p data-main=1>The lighthouse was built where the rocks are lowest, so that its light falls on the water
    in front of them and not only on the horizon, and ships have passed it safely ever since that day.</p>
    <p data-main=1>Its keeper, who lived there with two goats and a telescope, wrote down every ship that he
    saw, and the books that he left, all fourteen of them, are now kept in the library of the town.</p>
    <p data-main=0><a href="/p">Previous</a></p><p data-main=0><a href="/q">Next page</a></p></body>""",
    # Truncated, with marks in other languages.
    """<body><nav data-main=0><a href="/">Startseite</a></nav><div class="ad" data-main=0>Jetzt neu und nur heute.</div>
    <article data-main=1><h1>Der Wald im Winter</h1><p><b>Der Schnee liegt hoch.<br><p>Die Wege sind leer.</p>
    <p>Am Morgen</p><p>Nur Spuren führen über die Lichtung, und niemand weiß, wohin.</p>
    <footer data-main=0>Von A. Meier, zuletzt geändert am Montag</footer></article>
    <footer data-main=0>© Waldblatt · Alle Rechte vorbehalten. Nachdruck verboten.</footer>""",
    """<body><div role="navigation" data-main=0><p>Menu</p><a href="/1">Accueil</a></div>
    <div role="main" data-main=1><h2>La rue des lilas</h2><p>Oui.</p><p>On y trouve encore trois boutiques, dont une librairie.</p></div>
    <div class="subscribe-box" data-main=0><p>Recevez nos articles chaque semaine dans votre boîte.</p></div>
    <div class="disqus" data-main=0><p>Pierre a dit : je connais cette rue depuis mon enfance.</p><p>Merci !</p></div>
    <dialog data-main=0><p>Votre session va expirer. Voulez-vous continuer ?</p></dialog></body>""",
    # Cut off in the middle of the article.
    """<body><nav data-main=0><a href="/">Home</a></nav><article data-main=1><h1>Snow on the pass</h1>
    <p>The road has been closed since Tuesday, and the plough will not""",
    """<body><nav data-main=0><a href="/">Home</a> <a href="/k">Kitchen</a></nav><article data-main=1><h1>Plum jam</h1>
    <p>Stone""",
    """<body><div data-main=0><a href="/a">Up</a> <a href="/b">Down</a></div>
    <p data-main=1>The mill stood at the end of the lane, where the brook turns south, and its wheel could be
    heard from the church on days without wind, which were few in that part of the country.</p>
    <p data-main=1>When the miller died his sons sold the stones, and the house was let to a painter who
    liked the light, and who filled the granary with pictures of the same three poplars""",
    """<body><div data-main=0><a href="/a">Up</a></div>
    <p data-main=1>The ferry runs every hour from the first of May, and it takes bicycles, dogs and hand carts,
    but no cars, since the landing on the far side is nothing but a plank and two posts in the reeds.</p>
    <p data-main=1>Bring change.</p></body>""",
    # Marks that mean nothing inside an article.
    """<body><nav data-main=0><a href="/">Home</a></nav><article data-main=1><h1>An old postcard</h1>
    <p>On the back it said © 1924 in small letters.</p><p>© 1924, and no name.</p>
    <p><a href="/shop">The shop in Mill Street where we found it</a></p>
    <p><a href="/m">The museum's list of cards</a></p><p>Who wrote it?</p><p>Unsigned</p></article>
    <div class="pagination" data-main=0>Page 1 of 9</div></body>""",
    # Small text around an unmarked article.
    """<body><div data-main=0>Welcome</div><div data-main=0><a href="/a">All posts</a></div>
    <div data-main=1>The tower clock of our town has four faces, and no two of them have shown the same time since
    the winter of the great frost, when the oil in the works froze and the minute hands began to slip.</div>
    <div data-main=1>People who live on the north side are said to be always late, those on the south side early,
    and weddings are therefore held by the sundial on the wall of the school, weather permitting.</div>
    <div data-main=0>Share</div><div data-main=0>12 visits</div><div data-main=0>Print</div>
    <div data-main=0><a href="/r">Other stories from our town</a></div></body>""",
    """<body><p data-main=0>Sign in</p><p data-main=0>Cart</p>
    <p data-main=1>A good rope is made of three strands that are twisted against the twist of their yarns, so that
    each turn holds the other, and a rope walk must be as long as the longest rope it is to make.</p>
    <p data-main=1>Ours was three hundred paces long, under a roof of reeds, and boys walked it backwards all day.</p>
    <p data-main=0>Today</p><p data-main=0>Shipping</p></body>""",
    # Long rows of links.
    """<body><div data-main=0><a href="/1">Trains and trams</a> <a href="/2">Ships of the line</a> <a href="/3">Roads
    and bridges</a> <a href="/4">Canals and locks</a> <a href="/5">Balloons</a> <a href="/6">All the rest</a></div>
    <p data-main=1>The narrow railway up the valley was built for slate, and passengers were taken only because
    the law of the land asked for it, in a single carriage with <a href="/w">wooden benches</a> and no lamp.</p>
    <p data-main=1>It was closed on a Sunday in June, and the <a href="/v">rails</a> were sold before the week was over.</p>
    <p data-main=0><a href="/7">Older article about the slate works and the men who ran them</a> <a href="/8">Newer
    article about the flood in the lower valley</a></p>
    <p data-main=0><a href="/9">Tell us what you think about our pages on railways old and new</a></p></body>""",
    # Text and next to nothing else.
    """<p data-main=1>The letter came on a Monday, and nobody in the house dared to open it.</p>
    <p data-main=1>It lay on the table until the evening, when my aunt put on her glasses.</p>""",
    """<p data-main=1>All the lamps were lit at six, as they are on every winter evening in this town.</p>""",
    """<body><p data-main=1>There were nine of us in the boat and only four could row at all.</p>
    <p data-main=1>We drew lots for the oars.</p><div data-main=0><a href="/i">Index of tales</a></div></body>""",
    # Short blocks in marked articles: how short a block is says nothing there.
    """<body><nav data-main=0><a href="/">Home</a></nav><div class="ad" data-main=0>Now or never.</div>
    <article data-main=1><h1>Dialogue</h1><p>Well?</p><p>Well what?</p><p>Did you see it?</p><p>I did.</p><p>And?</p>
    <p>It was red.</p><p>Red.</p><p>As red as a brick, and about as large, and it lay there in the grass.</p><p>No.</p>
    <p>Yes it was, and it was still there when I came back an hour later with the ladder and the lamp.</p><p>Hm</p>
    <p>You never believe me</p><p>Not often</p><p><a href="/b">Brick</a></p><p>So</p><p>Good night.</p></article>
    <footer data-main=0>© The Dialogue Page</footer></body>""",
    """<body><header data-main=0><a href="/">Lists</a></header><main data-main=1><h1>What we packed</h1><ul><li>Rope</li>
    <li>Salt</li><li>Two knives</li><li>A map</li><li>Matches in a tin</li><li>Socks</li></ul><h2>Not packed</h2><ul>
    <li><a href="/t">Tent</a></li><li>Soap</li></ul><p>None of it was missed.</p><table><tr><td>1</td><td>kg</td></tr>
    <tr><td>20</td><td>litres</td></tr></table></main><aside data-main=0><p>Rope is sold by the yard in our shop.</p></aside></body>""",
    """<body><div id="entry" data-main=1><h2>Ja</h2><p>Nein.</p><p>Doch.</p><p>Ach so</p></div>
    <div class="comments" data-main=0><p>Schön.</p><p>Sehr schön geschrieben, danke dafür.</p></div></body>""",
    # Articles in wrappers whose names speak of the layout.
    """<body class="no-sidebar"><div id="page" class="site overflow-hidden"><div class="site-content has-sidebar"><article data-main=1>
    <h1>The well in the yard</h1><p>It was dug by hand, and the water has been cold ever since.</p><p>Nobody fills it in.</p>
    </article><div class="sidebar" data-main=0><p>Wells and pumps of all kinds, at our yard by the station.</p></div></div>
    <div class="site-footer" data-main=0><p>© The Yard Page. Write to us on any day.</p></div></div></body>""",
    """<body><div class="page-header-fixed social" aria-hidden="false"><div class="widget"><div class="entry-content" data-main=1>
    <h2>Two kites</h2><p>The red one flew, and the blue one came down in the neighbour's pear tree.</p><p>It is still there.</p>
    <div class="share" data-main=0>Send this on</div></div></div></div>
    <div class="comments" data-main=0><div class="content"><p>We had a kite like that, and it went the same way.</p></div></div></body>""",
    """<body><div class="sidebar-layout form"><main data-main=1><h1>Ice on the canal</h1><p>The locks were shut on Friday.</p>
    <p>Skaters came from three towns, and the baker sold out before noon.</p></main></div>
    <div class="related" data-main=0><article><p>How the canal was dug, and who paid for it in the end.</p></article></div>
    <div hidden data-main=0><article><p>This page was moved, and you should not see this text.</p></article></div></body>""",
)
