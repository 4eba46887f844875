"""Labelled pages that the content model learns from.

Small pages written for this purpose, in the layouts that web pages commonly
have. An attribute `b` marks an element that starts boilerplate, with all that is
in it; every other element belongs to the main text or holds it.
"""

#: The training pages.
PAGES = [
    """<html><body><nav b><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
    <div class=ad b>Buy one now.</div>
    <article><h1>A long walk</h1><p>We left early and walked along the river until noon.</p>
    <p><b>The bridge</b> was closed, so we went on.</p><p>It rained <em>all day</em>.</p>
    <ul><li>boots</li><li>a coat</li></ul></article>
    <div b><p>Seen by many people today.</p></div><footer b>&copy; somebody</footer></body></html>""",
    """<body><header b><a href=/>Site</a><form b><input><button>Search</button></form></header>
    <main><h1>Bread</h1><p>Flour and water.</p><h2>Method</h2><ol><li>Mix.</li><li>Wait.</li></ol>
    <div class="notice" b>We use cookies. <a href=/c>More</a></div>
    <p>Bake for an hour.</p><blockquote><p>My grandmother's words.</p></blockquote></main>
    <aside class=sidebar b><h3>Popular</h3><ul><li><a href=/x>One</a></li></ul></aside>
    <footer b><p>Imprint</p></footer></body>""",
    """<body><div id=header b><div class=logo>Name</div></div><div class="top menu" b><a href=/>Start</a> <a href=/q>Q</a></div>
    <div id=wrapper><div id=content class=post><h1>Stars</h1><div class=text><p>They are far.</p><p>Light takes years.</p></div>
    <div class="share social" b><a href=#>Share</a></div></div>
    <div id=sidebar b><div class=widget><h4>Archive</h4><ul><li><a href=/1>May</a></li></ul></div></div></div>
    <div id=comments b><h3>2 comments</h3><div class=comment><p>Nice text, I read it twice.</p></div>
    <div class=comment><p>I do not agree with the second part of it.</p></div></div>
    <div id=footer b>Terms</div></body>""",
    """<body><div class="cookie banner" b><p>This site stores data.</p><button>OK</button></div>
    <div role=navigation class=breadcrumbs b><a href=/>Top</a> / <a href=/t>Tools</a></div>
    <main role=main><article><header><h1>Hammers</h1></header><section><h2>Kinds</h2><p>There are many.</p>
    <table><thead><tr><th>Kind</th><th>Use</th></tr></thead><tbody><tr><td>Claw</td><td>Nails</td></tr></tbody></table></section>
    <figure><img src=h.jpg><figcaption>A claw hammer</figcaption></figure>
    <section class=related b><h2>See also</h2><ul><li><a href=/s>Saws</a></li></ul></section></article></main>
    <section class="comments-area" b><ol><li><article class=comment><p>Mine broke.</p></article></li></ol>
    <form class=reply b><textarea></textarea></form></section><footer role=contentinfo b>Shop Ltd</footer></body>""",
    """<body><div class=page><div class=navbar b><ul class=menu><li><a href=/>A</a><li><a href=/>B</a></ul></div>
    <div class="article body entry"><h1>Rivers</h1><div><span>Water</span> flows <a href=/d>downhill</a>, and always has.</div>
    <div class="advertisement sponsored" b><p>Sponsored: boats.</p></div><p>The end is the sea.</p>
    <pre><code>x = 1</code></pre><dl><dt>Delta</dt><dd>A mouth.</dd></dl></div>
    <div class="newsletter signup" b><p>Get our letter.</p><form b><input></form></div>
    <div class="pagination pager" b><a href=/2>Next</a></div></div></body>""",
    """<body><div class="modal popup overlay" b><p>Join us today!</p></div><div class=content>
    <h2>Tea</h2><p class=lead>Boil water.</p><p>Pour it on the leaves.</p><p class=notice b>This page was moved.</p>
    <p class=meta b><a href=/u>User</a></p><div class=quote><p>Good tea is slow.</p></div><ul class=list><li><p>Green</p></li><li>Black</li></ul>
    <div class="tags" b><a href=/t/1>tea</a></div><p class="promo" b>Try our cups.</p></div>
    <div class="recommended more popular trending" b><a href=/k>Kettles</a></div>
    <div class="copyright legal disclaimer" b>No warranty.</div></body>""",
    """<body><section class=masthead b><h1><a href=/>The Paper</a></h1></section><aside class="ads" b><p>Cheap flights</p></aside>
    <div class="main story"><h1>Vote ends</h1><p>The count took all night.</p><aside b><p>Read also: the first vote.</p></aside>
    <p>Nobody slept.</p><div class=caption>Counting</div></div><div class="reader discussion responses" b>
    <ul><li><div><p>They should count again.</p></div></li></ul></div>
    <div class="login search toolbar topbar" b><a href=/l>Log in</a></div></body>""",
    """<body><p>Only a page with some text.</p><p>And a second paragraph of it.</p><h2>Title</h2><div>Loose text.</div>
    <div class="alert" b>Maintenance on Sunday.</div><div class="gdpr consent privacy" b><p>Choose.</p></div>
    <form b><label>Name</label><input></form><ul class="nav navigation" b><li><a href=/>x</a></li></ul>
    <div class="hidden" b>skip</div><a class="skip" href=# b>Skip to text</a><p class=notification b>New messages.</p></body>""",
    """<body><header b><h1>My blog</h1><p>Notes and more</p></header><nav b><a href=/>1</a></nav>
    <div class=container><div class=row><div b><span>12 degrees</span></div><article class=post><header class=entry-header><h1>On time</h1></header>
    <div class="entry-content"><p>It passes.</p><h3>Clocks</h3><p>They <i>tell</i> it, <strong>mostly</strong>.</p>
    <div class="ad-slot" b>ad</div><ol><li>hour</li></ol></div><footer class="entry-meta" b>Posted in <a href=/c>notes</a></footer></article>
    <div class="respond" b><h3>Leave a reply</h3><form b><input></form></div></div></div>
    <div class="footer" b><p>All rights reserved.</p></div></body>""",
    """<body><div class="site-header" b><a href=/>Home</a></div><div class=header b><p>Welcome</p></div><div id=nav b><a href=/>a</a></div>
    <div class="story-body"><h1>Snow</h1><p>It fell all week.</p><p>Then it <a href=/m>melted</a>.</p>
    <div class="ads advert adsbygoogle" b><p>Skis at half price</p></div></div>
    <div class="page-footer site-footer" b><p>Contact</p></div><div class="user-comments comment" b><p>More snow, please.</p></div>
    <div class="side column" b><p>Weather</p></div><div class="menu" b><ul><li>x</li></ul></div><div class="breadcrumb" b>a</div></body>""",
    """<body><main><section><h1>Glass</h1><p>Sand is melted.</p><p>Then it cools<br>slowly.</p></section>
    <section><h2>Uses</h2><p>Windows.</p></section><section id=comments class=comment-list b><div><p>I like glass.</p></div></section>
    <div class="banner" b>Sale</div><div class="subscribe" b><p>Subscribe now.</p></div><div role=alert b>Old page</div>
    <div role=complementary b><p>Side text</p></div><div role=banner b>Top</div><div role=search b>Find</div></main>
    <div class="sidebar right" b><p>About me</p></div><div class="feedback" b><p>Was this of use?</p></div></body>""",
    """<body><div class="topbar" b><a href=/l>Log in</a></div><div class="main-nav" b><a href=/>Home</a></div>
    <div class="story post"><h1>Salt</h1><p>It was money once.</p><ul><li>rock</li><li>sea</li></ul>
    <div class="related-posts" b><a href=/p>Pepper</a></div><div class="share-buttons" b>Share</div></div>
    <div class="sidebar-widget" b><p>Latest</p></div><div class="newsletter subscribe" b><p>Letters</p></div>
    <section class="reader comments" b><h3>Comments</h3><div><p>Too much of it is bad.</p></div></section>
    <div class="sponsored promo" b><p>Buy pepper.</p></div><div class="footer legal" b><p>Terms of use</p></div></body>""",
    """<body><div class="cookie-consent notice" b><p>Cookies are used.</p></div><div class="banner ads" b><p>Sale</p></div>
    <main><div class="breadcrumb" b><a href=/>Top</a></div><h1>Wind</h1><p>It blows.</p><div class="text">From the west.</div>
    <div class="popular recommended" b><a href=/r>Rain</a></div><p>Then it stops.</p>
    <div class="discussion responses" b><p>Not here it does not.</p></div><div class="pagination" b><a href=/3>3</a></div></main>
    <div class="widget tags" b><a href=/t>tag</a></div><div class="search login" b><p>Find</p></div>
    <div class="modal alert" b><p>Sign up</p></div><div class="copyright disclaimer" b><p>Theirs</p></div></body>""",
    """<body class="site single"><div class="page site inner"><div class="columns row left"><div class="main column right area">
    <div class="box user list top"><h1>Iron</h1><p class="intro summary first">It rusts.</p><p class="text last">It bends.</p></div>
    <div class="slot bottom middle"><p>It melts, if <span class="term">heated</span> enough.</p></div></div></div>
    <div class="teaser" b><a href=/c>Copper</a></div><div class="reviews thread" b><p>I own some iron.</p></div>
    <div class="partner offer deals" b><p>Iron at a discount</p></div></div></body>""",
    """<body><div><header b><a href=/>Crafts</a></header></div><div class="ticker" b>Now</div><div class="hero article-title"><h1>Wool</h1></div><div class="article-content chapter">
    <p class=paragraph>Sheep are shorn.</p><div class="replies talkback" b><p>Poor sheep.</p></div><h2 class=heading>Spinning</h2>
    <p>Then it is spun.</p><div class="commercial sponsor adsense" b><p>Sheep for sale</p></div><div class="figure image"><p>A sheep</p></div>
    <div class="print email feed rss" b><a href=/p>Print</a></div></div><div class="tag searchbox" b>wool</div><div class="crumbs" b><a href=/>Up</a></div>
    <div class="languages links" b><a href=/de>de</a></div><div class="cart account register" b><p>Your cart</p></div>
    <div class="survey poll" b><p>Do you knit?</p></div><div class="warning message toast" b><p>Saved</p></div></body>""",
]
